"""Language-model scores from a subword lattice.

The pieces of an existing tokenizer file are the arcs of a word's lattice: every way to spell a space and the
word from them is a path, and the word's probability is the sum over all paths, by a forward recursion in
logarithms. The file's scores weight the pieces to begin with; forward-backward counts over the
words of the training texts then re-estimate the weights (the pieces themselves stay as they are). A word
that the training texts hold has one more arc, from end to end: its own frequency in their unigram
vocabulary. The share of that arc is estimated by leaving each occurrence out, so that new words keep a fair share.

    P(word) = share * count / N + (1 - share) * stop * sum over paths of the product of piece weights

A text is its words and one end, the word without letters, and its probability is their product. Word counts, expected piece counts
and scores are Spark aggregates and joins; only the piece weights (a bounded vocabulary) reach the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import text_chunks, written

#: A block of documents ends at this many of them, or at about this many (document, word) rows.
BLOCK_DOCS, BLOCK_ROWS = 1 << 16, 2_000_000
#: Bytes of words that one vectorised step handles; longer words than LONG_WORD are done one by one.
STEP, LONG_WORD = 1 << 18, 256


class Pieces:
    """The byte strings of a vocabulary as a trie, held as sorted (node * 256 + byte) transitions."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        move, self.ends = {}, [-1]
        for unit, s in enumerate(strings):
            node = 0
            for b in s:
                node = move.setdefault(node * 256 + b, len(move) + 1)
                if node == len(self.ends):
                    self.ends.append(-1)
            if node:
                self.ends[node] = unit
        keys = np.array(list(move), np.int64)
        order = np.argsort(keys)
        self.keys, self.next = keys[order], np.array(list(move.values()), np.int64)[order]
        self.ends = np.array(self.ends, np.int64)

    def arcs(self, data: np.ndarray, stop_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, unit) of every piece that the bytes hold; none passes ``stop_at`` of its start."""
        at = np.arange(len(data))
        node = np.zeros(len(data), np.int64)
        starts, ends, units = [], [], []
        depth = 0
        while len(at):
            key = node * 256 + data[at + depth]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[place] == key
            at, node = at[found], self.next[place[found]]
            depth += 1
            unit = self.ends[node]
            whole = unit >= 0
            starts.append(at[whole])
            ends.append(at[whole] + depth)
            units.append(unit[whole])
            more = at + depth < stop_at[at]
            at, node = at[more], node[more]
        return np.concatenate(starts), np.concatenate(ends), np.concatenate(units)


@dataclass
class Lattice:
    """Pieces with log weights; ``stop`` is the log weight of a word's end."""

    pieces: Pieces
    weights: np.ndarray
    stop: float

    def words(self, words: list[bytes], rates: np.ndarray | None = None, expected: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each word by its pieces. Given ``rates(log probabilities)``, adds
        each word's expected piece counts, at that rate, to ``expected`` (its last place counts stops)."""
        out = np.full(len(words), self.stop)  # the word without letters
        short = [i for i, w in enumerate(words) if 0 < len(w) <= LONG_WORD]
        at = 0
        while at < len(short):
            end, size = at, 0
            while end < len(short) and (size < STEP):
                size += len(words[short[end]]) + 1
                end += 1
            some = short[at:end]
            self._batch([words[i] for i in some], np.array(some), out, rates, expected)
            at = end
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                self._long(w, i, out, rates, expected)
        if rates is not None:
            expected[-1] += rates(out, np.arange(len(words))).sum()
        return out

    def _batch(self, words, rows, out, rates, expected):
        data = np.frombuffer(b" " + b" ".join(words), np.uint8)
        sizes = np.array([len(w) + 1 for w in words])
        last = np.cumsum(sizes)
        first = last - sizes
        stop_at = np.repeat(last, sizes)
        start, end, unit = self.pieces.arcs(data, stop_at)
        # node numbers: byte places plus one end per word
        word = np.repeat(np.arange(len(words)), sizes)[start]
        tail, head = start + word, end + word
        depth = end - first[word]
        order = np.lexsort((head, depth))
        tail, head, unit, word, depth = tail[order], head[order], unit[order], word[order], depth[order]
        alpha = np.full(len(data) + len(words), -np.inf)
        begin, final = first + np.arange(len(words)), last + np.arange(len(words))
        alpha[begin] = 0.0
        edges = np.concatenate(([0], np.cumsum(np.bincount(depth))))
        weight = self.weights[unit]
        for low, high in zip(edges[:-1], edges[1:]):  # all arcs that end at one depth
            if low < high:
                runs = np.flatnonzero(np.concatenate(([True], head[low + 1:high] != head[low:high - 1])))
                alpha[head[low:high][runs]] = np.logaddexp.reduceat(alpha[tail[low:high]] + weight[low:high], runs)
        out[rows] = alpha[final] + self.stop
        if rates is None:
            return
        beta = np.full(len(alpha), -np.inf)
        beta[final] = 0.0
        begins = depth - (head - tail)
        order = np.lexsort((tail, begins))
        edges = np.concatenate(([0], np.cumsum(np.bincount(begins))))
        for low, high in reversed(list(zip(edges[:-1], edges[1:]))):
            if low < high:
                o = order[low:high]
                runs = np.flatnonzero(np.concatenate(([True], tail[o][1:] != tail[o][:-1])))
                beta[tail[o][runs]] = np.logaddexp.reduceat(beta[head[o]] + weight[o], runs)
        rate = rates(out[rows], rows)
        with np.errstate(invalid="ignore"):
            share = np.exp(alpha[tail] + weight + beta[head] - alpha[final][word]) * rate[word]
        expected += np.bincount(unit, np.nan_to_num(share), minlength=len(expected))

    def _long(self, word, row, out, rates, expected):
        data = np.frombuffer(b" " + word, np.uint8)
        n = len(data)
        start, end, unit = self.pieces.arcs(data, np.full(n, n))
        order = np.lexsort((start, end))
        arcs = list(zip(start[order].tolist(), end[order].tolist(), self.weights[unit[order]].tolist()))
        alpha, beta = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
        alpha[0] = beta[n] = 0.0

        def add(x, y):
            x, y = (x, y) if x >= y else (y, x)
            return x + math.log1p(math.exp(y - x)) if y > -math.inf else x

        for s, e, w in arcs:
            alpha[e] = add(alpha[e], alpha[s] + w)
        out[row] = alpha[n] + self.stop
        if rates is None:
            return
        for i in np.lexsort((end[order], -start[order])).tolist():
            s, e, w = arcs[i]
            beta[s] = add(beta[s], beta[e] + w)
        alpha, beta = np.array(alpha), np.array(beta)
        rate = rates(out[[row]], np.array([row]))[0]
        share = np.exp(alpha[start] + self.weights[unit] + beta[end] - alpha[n]) * rate
        expected += np.bincount(unit, share, minlength=len(expected))


def vocabulary(path: str, scores: str = "rank") -> tuple[list[bytes], np.ndarray]:
    """Byte strings and prior weights (adding up to 1) of a sentencepiece file's pieces.

    ``scores`` says what the file's scores are: logarithms ("log") of a unigram model, or an order
    only ("rank"), whose r-th piece weighs 1 / (r + 10). Control and unused pieces are left out; pieces of one
    byte string are one, and every byte is a piece, the rarest if the file gives it no score of its own.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    found: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)):
            s = model.id_to_piece(i).replace("▁", " ").encode()
            if s.rfind(b" ") <= 0:  # a space begins a word, so it can't lie within a piece
                found[s] = max(found.get(s, -math.inf), model.get_score(i))
    strings = sorted(found, key=lambda s: (-found[s], s))
    weights = [math.exp(found[s]) for s in strings] if scores == "log" else [1 / (r + 10) for r in range(len(strings))]
    least = min(weights, default=1.0)
    for b in range(256):
        if bytes([b]) not in found:
            strings.append(bytes([b]))
            weights.append(least)
    return strings, np.array(weights) / sum(weights)


def _indexer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (id, text, train) to rows of documents (word null) and of the words of their block (place null)."""
    context = TaskContext.get()
    block = (context.partitionId() if context else 0) << 32
    names = ["block", "place", "id", "train", "n_tokens", "words", "times", "at", "word", "n_train"]
    number: dict[bytes, int] = {}
    learned: Counter = Counter()
    place = rows = 0
    id_type = pa.int64()

    def word_rows() -> Iterator[pa.RecordBatch]:
        found = list(number)
        for low in range(0, len(found), 50_000):
            some = found[low:low + 50_000]
            none = [pa.nulls(len(some), t) for t in (pa.int32(), id_type, pa.bool_(), pa.int64(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), block)), *none, pa.array(np.arange(low, low + len(some), dtype=np.int32)),
                 pa.array(some, pa.binary()), pa.array([learned[w] for w in some], pa.int64())], names)

    for chunk in text_chunks(batches):
        id_type = chunk.column(0).type
        for low in range(0, chunk.num_rows, 1024):
            part = chunk.slice(low, 1024)
            m = part.num_rows
            if place and (place + m > BLOCK_DOCS or rows >= BLOCK_ROWS):
                yield from word_rows()
                number, learned, place, rows, block = {}, Counter(), 0, 0, block + 1
            train = part.column(2).to_pylist()
            tokens, at, times = [], [], []
            for text, use in zip(part.column(1).to_pylist(), train):
                words = text.encode().lower().split() if text else []  # bytes: A-Z and ASCII white space only
                counts = Counter(words)
                tokens.append(len(words) + 1)
                counts[b""] = 1
                at.append(np.array([number.setdefault(w, len(number)) for w in counts], "<u4").tobytes())
                times.append(np.array(list(counts.values()), "<u4"))
                if use:
                    learned.update(counts)
                rows += len(counts)
            # counts in as few bytes as a text's greatest needs
            packed = [t.astype("<u1" if t.max() < 256 else "<u4").tobytes() for t in times]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, block)), pa.array(np.arange(place, place + m, dtype=np.int32)), part.column(0),
                 part.column(2), pa.array(tokens, pa.int64()), pa.array(at, pa.binary()), pa.array(packed, pa.binary()),
                 *(pa.nulls(m, t) for t in (pa.int32(), pa.binary(), pa.int64()))], names)
            place += m
    if place:
        yield from word_rows()


def _log(x: float) -> float:
    return math.log(x) if x > 0 else -math.inf


def _fit(counts: DataFrame, total: int, strings: list[bytes], prior: np.ndarray, rounds: int,
         strength: float) -> tuple[np.ndarray, float, float]:
    """Log weights of the pieces, log weight of a word's end, and the share of whole words."""
    weights, stop, share = np.log(prior * 0.75), math.log(0.25), 0.5
    seen = counts.where("count > 0")
    for _ in range(rounds):
        def expect(batches: Iterator[pa.RecordBatch], weights=weights, stop=stop, share=share) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(Pieces(strings), weights, stop)
            expected = np.zeros(len(strings) + 2)
            for batch in batches:
                count = np.asarray(batch.column(1), float)
                others = share * (count - 1) / max(total - 1, 1)  # the word's frequency without this occurrence

                def rates(logs, rows):
                    spelled = (1 - share) * np.exp(logs)
                    return count[rows] * np.divide(spelled, spelled + others[rows], out=np.ones(len(rows)),
                                                   where=spelled + others[rows] > 0)

                logs = lattice.words(batch.column(0).to_pylist(), rates, expected[:-1])
                expected[-1] += count.sum() - rates(logs, np.arange(len(count))).sum()
            at = np.flatnonzero(expected)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(expected[at])], ["unit", "n"])

        sums = seen.mapInArrow(expect, "unit long, n double").groupBy("unit").agg(F.sum("n").alias("n")).collect()
        expected = np.zeros(len(strings) + 2)
        for r in sums:
            expected[r["unit"]] = r["n"]
        all_ = expected[:-1].sum() + strength
        if not total:
            break
        weights = np.log((expected[:-2] + 0.75 * strength * prior) / all_)
        stop = math.log((expected[-2] + 0.25 * strength) / all_)
        share = min(max(expected[-1] / total, 0.0), 1 - 1e-9)
    return weights, stop, share if total else 0.0


def _scored(n: int, distinct: int):
    rest = n + 0.5 * (distinct + 1)

    def run(table: pa.Table) -> pa.Table:
        """The documents of one block, scored by its words."""
        is_doc = pa.compute.is_valid(table["place"])
        docs, words = table.filter(is_doc), table.filter(pa.compute.invert(is_doc))
        at = np.asarray(words["at"].combine_chunks())
        count, logs = np.zeros(len(at), np.int64), np.zeros(len(at))
        count[at], logs[at] = np.asarray(words["count"].combine_chunks()), np.asarray(words["log10"].combine_chunks())
        base = np.log10((count + 0.5) / rest)
        known, base_score, score = [], [], []
        for w, t in zip(docs["words"].to_pylist(), docs["times"].to_pylist()):
            w = np.frombuffer(w, "<u4")
            t = np.frombuffer(t, f"<u{len(t) // len(w)}").astype(np.int64)
            known.append(int(t[count[w] > 0].sum()))
            base_score.append(float(t @ base[w]))
            score.append(float(t @ logs[w]))
        m = docs.num_rows
        return pa.table([docs["id"], docs["train"], docs["n_tokens"], pa.array(known, pa.int64()), pa.array([n] * m, pa.int64()),
                         pa.array(base_score, pa.float64()), pa.array(score, pa.float64())],
                        names=["id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score_texts(docs: DataFrame, vocabulary_path: str, train: Column, id_col: str = "doc_id", text_col: str = "text",
                rounds: int = 3, strength: float = 1000.0, scores: str = "rank") -> DataFrame:
    """id, train, n_tokens, n_known, train_tokens, base_score, score (log10) of every row, whole texts.

    Tokens are the words (runs free of ASCII white space, A-Z lowered) and one end. The model learns
    from the rows where ``train`` is true, null counting as false; ``base_score`` is their add-half unigram model with one unknown
    word. ``rounds`` re-estimate the piece weights, ``strength`` is the weight of the file's own scores in that, in pieces.
    Null and empty texts are an end alone. Any byte is a piece, so that every text has a probability above 0, also
    if nothing was learned. Rows with null or equal ids and repeated rows are rows of
    their own; an empty table gives no rows; other columns are ignored.
    """
    session = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(train, F.lit(False)).alias("train"))
    kind = slim.schema["id"].dataType.simpleString()
    index = written(slim.mapInArrow(
        _indexer, f"block long, place int, id {kind}, train boolean, n_tokens long, words binary, times binary, "
                  "at int, word binary, n_train long"), "word-index")
    held = index.where("word is not null").select("block", "at", "word", "n_train")
    counts = written(held.groupBy("word").agg(F.sum("n_train").alias("count")), "word-counts")
    n, distinct = counts.where("count > 0").agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    strings, prior = vocabulary(vocabulary_path, scores)
    weights, stop, share = _fit(counts, n, strings, prior, rounds, strength)
    model = session.sparkContext.broadcast((strings, weights, stop))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings, weights, stop = model.value
        lattice = Lattice(Pieces(strings), weights, stop)
        for batch in batches:
            logs = lattice.words(batch.column(0).to_pylist()) + math.log1p(-share)
            with np.errstate(divide="ignore"):
                whole = np.log(np.asarray(batch.column(1)) / max(n, 1)) + _log(share)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.logaddexp(logs, whole) / math.log(10))],
                ["word", "count", "log10"])

    spelled = written(counts.mapInArrow(spell, "word binary, count long, log10 double"), "word-scores")
    words = held.join(spelled, "word").select("block", "at", "count", "log10")
    rows = index.where("word is null").select("block", "place", "id", "train", "n_tokens", "words", "times")
    return rows.unionByName(words, allowMissingColumns=True).groupBy("block").applyInArrow(
        _scored(n, distinct), f"id {kind}, train boolean, n_tokens long, n_known long, train_tokens long, "
                              "base_score double, score double").withColumnRenamed("id", id_col)
