"""Language identification by word-first backoff.

A word of a text that the model knows scores the log frequency it has in each
language. An unseen word falls back to character n-grams of the word
with its ends marked, longest first: where the n-gram at a place is unknown,
the next shorter one there counts, less a fixed penalty. The text's language is
the one with the largest sum; the score is its posterior among the learned ones.

Frequencies are smoothed toward a background that all languages share, the mean of their relative
frequencies: a word that one language alone has always speaks for it, also beside a language
of a few texts, whose own unseen words would otherwise look likelier than rare words of a large one.

Words are runs of letters (Unicode category L). Texts are handled as arrays of code points: words and n-grams
are looked up by 64-bit hashes, so two different ones are confused with a chance of about 1e-13 a text.

Counts come from Spark aggregates over a bounded sample of each language's labelled documents
(``max_fit_docs``, ``least_lang_docs``), so the model that goes to the executors is bounded too,
and a language is learned however rare it is.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import text_chunks
from bandwise.llm.shingles import _BACK, _BASE, _powers, mix

#: Letters and number signs that aren't decimal digits; ``words_of`` cuts out the latter.
WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
#: Code points that one vectorised step handles, unless one word is longer.
STEP = 1 << 19
#: Scores (words x languages) that one step gathers.
GATHER = 1 << 22
_BEGIN, _END = ord("^"), ord("$")


def words_of(text: str) -> Counter:
    counts = Counter(WORD.findall(text.lower()))
    for word in [w for w in counts if not w.isalpha()]:
        n = counts.pop(word)
        for part in "".join(c if c.isalpha() else " " for c in word).split():
            counts[part] += n
    return counts


def grams_of(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters; made once a process."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTERS[0]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _values(points: np.ndarray) -> np.ndarray:
    return mix((points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def _spans(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of an array begin and end."""
    edge = np.diff(np.concatenate(([False], letters()[points], [False])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class Hasher:
    """64-bit hashes of words within an array of code points; keeps the powers it needs."""

    def __init__(self):
        self.up, self.down = _powers(_BASE, STEP), _powers(_BACK, STEP)

    def words(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(points)
        up, down = (self.up, self.down) if n <= len(self.up) else (_powers(_BASE, n), _powers(_BACK, n))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_values(points) * up[:n], dtype=np.uint64, out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(points: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n code points."""
    values, m = _values(points), max(len(points) - n + 1, 0)
    total = np.zeros(m, np.uint64)
    for j in range(n):
        total = total * _BASE + values[j:j + m]
    return mix(total + np.uint64(n))


def _marked(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words one behind the other with their ends marked, and the length of each."""
    sizes = ends - starts + 2
    last = np.cumsum(sizes)
    source = np.arange(int(last[-1])) + np.repeat(starts - 1 - (last - sizes), sizes)
    out = points[np.clip(source, 0, len(points) - 1)]
    out[last - sizes], out[last - 1] = _BEGIN, _END
    return out, sizes


class Lookup:
    """Rows of a score table by hash."""

    def __init__(self, hashes: np.ndarray, scores: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.scores = hashes[order], scores[order]

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, -1 where there is none."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


@dataclass
class LanguageModel:
    """Log frequencies: one row per known word (gram), one column per language."""

    langs: list[str]
    words: Lookup
    grams: Lookup
    unknown: np.ndarray
    longest: int
    penalty: float

    def unseen(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each word the mean over its places of the longest known n-gram there."""
        marked, sizes = _marked(points, starts, ends)
        last = np.cumsum(sizes)
        left = np.repeat(last, sizes) - np.arange(len(marked))  # code points from a place to its word's end
        total = np.tile(self.unknown + self.penalty * self.longest, (len(marked), 1))
        open_ = left > 1
        total[~open_] = 0
        for n in range(self.longest, 0, -1):
            at = np.flatnonzero(open_ & (left >= n))
            row = self.grams.rows(gram_hashes(marked, n)[at])
            found = at[row >= 0]
            total[found] = self.grams.scores[row[row >= 0]] + self.penalty * (self.longest - n)
            open_[found] = False
        return np.add.reduceat(total, last - sizes) / (sizes - 1)[:, None]

    def step_sums(self, hasher: Hasher, points: np.ndarray, texts: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
        """Summed scores and number of words of each text; ``texts`` numbers the text of each code point, in order."""
        sums, counts = np.zeros((n_texts, len(self.langs))), np.zeros(n_texts, np.int64)
        starts, ends = _spans(points)
        if not len(starts):
            return sums, counts
        owner, hashes = texts[starts], hasher.words(points, starts, ends)
        row = self.words.rows(hashes)
        new = np.flatnonzero(row < 0)
        scores = self.words.scores
        if len(new):
            _, first, place = np.unique(hashes[new], return_index=True, return_inverse=True)
            row[new] = len(scores) + place
            rest = [self.unseen(points, starts[at], ends[at]) for at in self._dealt(new[first], ends - starts)]
            scores = np.concatenate([scores, *rest])
        counts += np.bincount(owner, minlength=n_texts)
        many = max(GATHER // max(len(self.langs), 1), 1)
        for at in range(0, len(row), many):
            part, of = row[at:at + many], owner[at:at + many]
            edges = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            sums[of[edges]] += np.add.reduceat(scores[part], edges)
        return sums, counts

    def _dealt(self, words: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
        """Words in runs of a bounded number of scores, one word at least."""
        most, total = max(GATHER // max(len(self.langs), 1), 1), np.cumsum(sizes[words] + 2)
        begin = 0
        while begin < len(words):
            before = total[begin - 1] if begin else 0
            end = max(int(np.searchsorted(total, before + most, side="right")), begin + 1)
            yield words[begin:end]
            begin = end

    def judge(self, hasher: Hasher, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and posterior of each text."""
        sums, counts = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        if self.langs:
            for points, owner in _steps(texts):
                some, n = self.step_sums(hasher, points, owner, len(texts))
                sums += some
                counts += n
        if not counts.any():
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        best = np.argmax(sums, axis=1)
        posterior = 1.0 / np.exp(sums - np.take_along_axis(sums, best[:, None], 1)).sum(axis=1)
        return ([self.langs[b] if n else UNDETERMINED for b, n in zip(best.tolist(), counts.tolist())],
                np.where(counts > 0, posterior, 0.0))


def _steps(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts' lower-cased code points in steps of about ``STEP``, and which text each is of. Steps end between
    words, and a code point that is no letter stands between two texts."""
    gap = np.array([10], np.uint32)
    parts, owners, size = [], [], 0
    for i, text in enumerate(texts):
        points, at = _points(text.lower()) if text else gap, 0
        while at < len(points):
            end = min(at + STEP - size, len(points)) if size < STEP else at
            if end < len(points):
                gaps = np.flatnonzero(~letters()[points[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                elif parts:
                    end = at
                else:  # a word longer than a step
                    rest = np.flatnonzero(~letters()[points[end:]])
                    end = end + int(rest[0]) + 1 if len(rest) else len(points)
            if end > at:
                parts += [points[at:end], gap]
                owners += [i, i]
                size += end - at + 1
            if end < len(points) or size >= STEP:
                yield np.concatenate(parts), np.repeat(owners, [len(p) for p in parts])
                parts, owners, size = [], [], 0
            at = end
    if parts:
        yield np.concatenate(parts), np.repeat(owners, [len(p) for p in parts])


def sample_by_language(usable: DataFrame, most: int, least: int) -> DataFrame:
    """All rows of doc_id, lang, ..., or about ``most`` of more, chosen by hash of the id: languages with few rows
    keep them all, the others get equal numbers, which are never under ``least``."""
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if sum(sizes.values()) <= most:
        return usable
    level, left = 0.0, float(most)
    for i, n in enumerate(sorted(sizes.values())):  # what is left, dealt evenly among the larger ones
        level = left / (len(sizes) - i)
        if n > level:
            break
        left -= n
    level = max(level, least)
    cuts = [F.lit(x) for lang, n in sorted(sizes.items()) if n > level for x in (lang, int(level / n * (1 << 40)))]
    if not cuts:
        return usable
    cut = F.coalesce(F.try_element_at(F.create_map(*cuts), F.col("lang")), F.lit(1 << 40))
    return usable.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40)) < cut)


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", max_fit_docs: int = 4000, min_count: int = 3,
                  longest: int = 4, penalty: float = -1.0, prior: float = 100.0,
                  least_lang_docs: int = 100) -> LanguageModel:
    """Model from the rows with text and language: all of them, or about ``max_fit_docs`` of more,
    dealt among the languages (``sample_by_language``): a language has all its rows in it or
    ``least_lang_docs`` at least, also if that makes more in all. Words and n-grams seen ``min_count`` times are kept; ``prior`` is the
    number of occurrences that the shared background counts for in every language."""
    usable = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                         F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    sample = sample_by_language(usable, max_fit_docs, least_lang_docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            total: dict[str, Counter] = {}
            for text, lang in zip(chunk.column(1).to_pylist(), chunk.column(2).to_pylist()):
                total.setdefault(lang, Counter()).update(words_of(text))
            rows = [(lang, w, n) for lang, c in total.items() for w, n in c.items()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))],
                    ["lang", "word", "n"])

    words = sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n")).persist()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total: Counter = Counter()
            for lang, word, n in zip(*(c.to_pylist() for c in b.columns)):
                for size in range(1, longest + 1):
                    for g in grams_of(word, size):
                        total[lang, g] += n
            rows = [(lang, g, n) for (lang, g), n in total.items()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))],
                    ["lang", "word", "n"])

    grams = words.mapInArrow(split, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n"))

    def collected(counts: DataFrame) -> list[tuple]:
        kept = counts.groupBy("word").agg(F.sum("n").alias("all"), F.map_from_entries(
            F.collect_list(F.struct("lang", "n"))).alias("by")).where(F.col("all") >= min_count)
        return [(r["word"], r["by"]) for r in kept.select("word", "by").toLocalIterator()]

    sums = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(sums)
    known, parts = collected(words), collected(grams)
    words.unpersist()

    def scores(rows: list[tuple], totals: np.ndarray) -> np.ndarray:
        n = np.array([[by.get(lang, 0) for lang in langs] for _, by in rows], float).reshape(len(rows), len(langs))
        background = (n / np.maximum(totals, 1)).sum(axis=1, keepdims=True) / max(len(langs), 1)
        return np.log((n + prior * background) / (totals + prior))

    gram_n = np.zeros(len(langs))
    gram_scores, gram_keys = [np.zeros((0, len(langs)))], [np.zeros(0, np.uint64)]
    for size in range(1, longest + 1):
        rows = [r for r in parts if len(r[0]) == size]
        if rows:
            gram_n = np.array([sum(by.get(lang, 0) for _, by in rows) for lang in langs], float)
            gram_scores.append(scores(rows, gram_n))
            gram_keys.append(gram_hashes(_points("".join(g for g, _ in rows)), size)[::size])
    totals = np.array([sums[lang] for lang in langs], float)
    unknown = np.full(len(langs), -np.log(gram_n.max() + 2)) if len(langs) else np.zeros(0)
    listed = _points("\n".join(w for w, _ in known))
    words_at = Lookup(Hasher().words(listed, *_spans(listed)), scores(known, totals))
    return LanguageModel(langs, words_at, Lookup(np.concatenate(gram_keys), np.concatenate(gram_scores)), unknown,
                         longest, penalty)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row, whole texts.

    Null texts, empty ones and texts without a letter are ``und`` with score 0,
    as is everything under a model that learned no language. Ties go to the
    language that sorts first. Repeated rows and null ids are rows like any
    other; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for chunk in text_chunks(batches):
            langs, scores = shared.value.judge(hasher, chunk.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
