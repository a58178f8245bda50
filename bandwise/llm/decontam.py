"""Benchmark decontamination by template windows.

Texts are canonicalised word by word: numbers, names and units become typed placeholders, the
rest is lower-cased and stripped of marks. Windows of ``window`` canonical words are hashed; the
windows of documents that may be a benchmark window (by a fixed-size bit table) are
joined with the benchmark's on the hash. Within a document, an item and an alignment, the
placeholders' fillers must map one to one between the item and the document: then a question with other
numbers or names is still that question, while a chance overlap of phrases is not.

A capitalised word that begins a text or a sentence may be a word or a name: windows are hashed in both
readings. Every window is also read with all its capitalised words as words: so an item is found
in Title Case too. A window of placeholders alone that are filled otherwise counts only beside one with a word. Scripts written without spaces are cut into characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import text_chunks, written
from bandwise.llm.shingles import _UP, mix

#: Unit words and signs that stand for a unit of measure.
UNITS = frozenset((
    "mm cm m km inch inches foot feet mile miles yard yards mg g kg gram grams kilogram kilograms ton tons pound pounds "
    "ounce ounces ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours day days week "
    "weeks month months year years dollar dollars euro euros cent cents percent degree degrees meter meters metre metres "
    "kilometer kilometers kilometre kilometres mph kmh watt watts volt volts € $ £ %").split())
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"^\d[\d.,:/]*[a-z]{0,2}$")
NUMBER, UNIT, NAME = 1, 2, 3
_STOPS = frozenset(".!?:。！？：")
#: Characters of scripts without spaces between words: Thai, Lao, Burmese, Khmer, kana, Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
                       "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
#: Readings that one vectorised step makes at most.
_STEP = 1 << 18
#: Words that a task's memo keeps from one chunk of texts to the next (about 250 bytes each), and bytes of text in a chunk.
MEMO_WORDS, MEMO_CHARS = 100_000, 500_000
#: Bits of the table that tells windows which can't be a benchmark window (8 MB, whatever the benchmark's size).
TABLE_BITS = 26


class Canonical:
    """Canonical codes of words, with a bounded memo: code, code within a sentence, ends a
    sentence, filler."""

    def __init__(self, limit: int = MEMO_WORDS):
        self.limit = limit
        self.at: dict[str, int] = {}
        self.fill: list[str] = []
        self.code = np.zeros(1 << 16, np.uint64)
        self.name = np.zeros(1 << 16, np.uint64)
        self.ends = np.zeros(1 << 16, bool)

    def _learn(self, word: str) -> int:
        row = self.at[word] = len(self.fill)
        if row == len(self.code):
            self.code, self.name, self.ends = (np.concatenate((x, np.zeros_like(x)))
                                               for x in (self.code, self.name, self.ends))
        bare = word if word.isalpha() else _EDGES.sub("", word)
        low = bare.lower()
        self.ends[row] = word.rstrip("\"')]»”’")[-1:] in _STOPS
        code = name = 0
        if low in UNITS or not bare and word in UNITS:
            code = name = UNIT
            low = low or word
        elif low and low[0].isdigit() and _NUMBER.match(low):
            code = name = NUMBER
        elif low:
            code = name = max(xxhash.xxh64_intdigest(low.encode()), 16)
            if len(bare) > 1 and bare[0].isupper() and bare[1:].islower():
                name = NAME
        self.fill.append(low)
        self.code[row], self.name[row] = code, name
        return row

    def trim(self) -> None:
        """Forget all words if there are too many; rows given before are void then."""
        if len(self.fill) > self.limit:
            self.at.clear()
            self.fill.clear()

    def codes(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Codes of a text's words (a capitalised word that doesn't begin a sentence is a name), their
        memo rows, which may be names as well (capitalised words that begin the text or a sentence), and
        the codes without names. Words without a letter, digit or unit sign are left out."""
        if text and not text.isascii() and _UNSPACED.search(text):
            text = _UNSPACED.sub(r" \g<0> ", text)
        parts, at = text.split() if text else [], self.at
        if not parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.uint64)
        found = list(map(at.get, parts))
        if None in found:
            for i, row in enumerate(found):
                if row is None:
                    row = at.get(parts[i])
                    found[i] = self._learn(parts[i]) if row is None else row
        rows = np.array(found)
        begins = np.concatenate(([True], self.ends[rows[:-1]]))
        word, name = self.code[rows], self.name[rows]
        out = np.where(begins, word, name)
        some = out != 0
        return out[some], rows[some], (begins & (word != name))[some], word[some]


def _sums(codes: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(len(codes) - n + 1, np.uint64)
    for i in range(n):
        total = total * _UP[1] + codes[i:i + len(total)]
    return total


def _readings(codes: np.ndarray, maybe: np.ndarray, n: int, plain: np.ndarray, text: np.ndarray | None = None) -> Iterator[
        tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place, hash, names) of all readings of the windows of n words; the bits of ``names`` tell which
    of the window's words that may be names are read as such. The sum under a reading's hash is
    that of the first reading with a name's code in the word's place. ``text`` numbers the texts that
    the words are of: no window spans two."""
    m = len(codes) - n + 1
    if m < 1:
        return
    total = np.zeros(m, np.uint64)
    for i in range(n):
        total = total * _UP[1] + codes[i:i + m]
    within = np.ones(m, bool) if text is None else text[:m] == text[n - 1:]
    whole = np.flatnonzero(within)
    yield whole, mix(total[whole] + np.uint64(n)), np.zeros(len(whole), np.int64)
    inside = np.concatenate(([0], np.cumsum(plain != codes)))
    named = np.flatnonzero((inside[n:] > inside[:m]) & within)
    if len(named):
        yield named, mix(_sums(plain, n)[named] + np.uint64(n)), np.full(len(named), -1)
    places = np.flatnonzero(maybe)
    if not len(places):
        return
    before = np.concatenate(([0], np.cumsum(maybe)))
    first, count = before[:m], (before[n:] - before[:m]) * within
    change = np.uint64(NAME) - codes[places]
    for k in range(1, int(count.max()) + 1):
        same, step = np.flatnonzero(count == k), max(_STEP >> k, 1)
        for start in range(0, len(same), step):
            at = same[start:start + step]
            read = total[at][None, :]
            for j in range(k):
                word = first[at] + j
                read = np.concatenate((read, read + change[word] * _UP[n - 1 - (places[word] - at)]))
            yield (np.tile(at, len(read) - 1), mix(read[1:].ravel() + np.uint64(n)),
                   np.repeat(np.arange(1, len(read)), len(at)))


def _fillers(canon: Canonical, codes: np.ndarray, rows, maybe, plain, at: int, n: int, names: int) -> tuple[list[str], list[bool]]:
    """Fillers of a reading's placeholders, and which of them are words read as names."""
    fill, begin = [], []
    for i in range(at, at + n):
        if names < 0:
            if plain[i] in (NUMBER, UNIT):
                fill.append(canon.fill[rows[i]])
                begin.append(False)
        elif maybe[i]:
            if names & 1:
                fill.append(canon.fill[rows[i]])
                begin.append(True)
            names >>= 1
        elif codes[i] in (NUMBER, UNIT, NAME):
            fill.append(canon.fill[rows[i]])
            begin.append(False)
    return fill, begin


def _item_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canon, out = Canonical(), []
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                canon.trim()
                codes, rows, maybe, plain = canon.codes(text)
                n = min(window, len(codes))
                for ats, hashes, names in _readings(codes, maybe, n, plain) if n else ():
                    for at, h, name in zip(ats.tolist(), hashes.view(np.int64).tolist(), names.tolist()):
                        out.append((item, n, h, at, len(codes) - n + 1, *_fillers(canon, codes, rows, maybe, plain, at, n, name)))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(),
                                                            pa.list_(pa.string()), pa.list_(pa.bool_())))],
                ["item_id", "width", "hash", "item_at", "item_windows", "item_fill", "item_begin"])
    return run


def _bits(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _doc_windows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canon = Canonical()
        table, widths = shared.value
        table = np.frombuffer(table, np.uint8)
        for chunk in text_chunks(batches, chars=MEMO_CHARS):
            out, docs = [], chunk.column(0).to_pylist()
            canon.trim()
            got = [canon.codes(text) for text in chunk.column(1).to_pylist()]
            sizes = np.array([len(parts[0]) for parts in got])
            starts, text = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(got)), sizes)
            codes, rows, maybe, plain = (np.concatenate(x) for x in zip(*got))
            for n in widths:
                for ats, hashes, names in _readings(codes, maybe, n, plain, text):
                    bit = _bits(hashes)
                    for i in np.flatnonzero(table[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).tolist():
                        at = int(ats[i])
                        out.append((docs[text[at]], n, int(hashes[i].view(np.int64)), at - int(starts[text[at]]),
                                    *_fillers(canon, codes, rows, maybe, plain, at, n, int(names[i]))))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                                                                pa.list_(pa.string()), pa.list_(pa.bool_())))],
                    ["doc_id", "width", "hash", "doc_at", "doc_fill", "doc_begin"])
    return run


def _bit_table(items: DataFrame) -> bytes:
    """The benchmark windows' bits, gathered in pieces of a fixed number."""
    bit = F.shiftrightunsigned("hash", 64 - TABLE_BITS)
    words = items.select(F.shiftright(bit, 5).alias("word"), F.pmod(bit, F.lit(32)).alias("bit")).distinct().groupBy(
        "word").agg(F.sum(F.pow(F.lit(2.0), F.col("bit")).cast("long")).alias("value"))
    table = np.zeros(1 << (TABLE_BITS - 5), "<u4")
    for r in words.toLocalIterator():  # 2 ** 21 words at most
        table[r["word"]] = r["value"]
    return table.tobytes()


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 window: int = 8, shortest: int = 5, least: float = 0.5) -> DataFrame:
    """doc_id, item_id, n_windows, coverage, n_slots, reparameterised: documents that hold an item.

    A document holds an item if windows with consistent slots cover ``least`` of the item's windows.
    An item of fewer than ``window`` canonical words is one window of its own length, in which a word that begins
    a sentence must be the same; one of fewer than ``shortest`` must be there word for word, numbers, names and units
    included. Windows of placeholders alone, filled otherwise than the item's, count only if
    a window with a word, or with equal fillers, stands in line with them. Words that begin a sentence and differ are slots like names if the slots of all windows are
    consistent with them; else the windows without them decide. ``reparameterised``: some filler differs. Null and
    empty texts, and those without a letter, digit or unit sign, hold nothing; rows with null ids are left out, repeated rows count once, repeated items count by id; an empty table on either
    side gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = written(items.where("item_id is not null and text is not null").mapInArrow(
        _item_windows(window), "item_id long, width int, hash long, item_at long, item_windows long, "
        "item_fill array<string>, item_begin array<boolean>"), "benchmark-windows")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # 1 to window
    shared = spark.sparkContext.broadcast((_bit_table(items), widths))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = written(slim.where("doc_id is not null and text is not null").mapInArrow(
        _doc_windows(shared), "doc_id long, width int, hash long, doc_at long, doc_fill array<string>, doc_begin array<boolean>"), "windows")
    hits = found.join(items, ["hash", "width"]).where(F.size("doc_fill") == F.size("item_fill"))
    told = F.arrays_zip("item_fill", "doc_fill", "item_begin", "doc_begin")
    begins, differs = lambda p: p["item_begin"] | p["doc_begin"], lambda p: p["item_fill"] != p["doc_fill"]
    pairs = F.transform(F.filter(told, lambda p: ~begins(p) | differs(p)), lambda p: F.struct(
        p["item_fill"].alias("item_fill"), p["doc_fill"].alias("doc_fill")))
    hits = hits.select("doc_id", "item_id", "item_windows", "item_at", (F.col("doc_at") - F.col("item_at")).alias("shift"),
                       pairs.alias("pairs"), F.exists(told, lambda p: begins(p) & differs(p)).alias("loose"),
                       F.when(F.col("width") < shortest, ~F.exists(told, differs)).otherwise(True).alias("exact"),
                       ((F.size("item_fill") < F.col("width")) | ~F.exists(told, differs)).alias("told"), "width").where("exact").where(~F.col("loose") | (F.col("width") == window))
    # one alignment of a document with an item: its windows, and the fillers they pair
    distinct = lambda c: F.array_distinct(F.flatten(F.collect_set(c)))
    strict = lambda c: F.when(~F.col("loose"), F.col(c))
    lines = hits.groupBy("doc_id", "item_id", "item_windows", "shift").agg(
        F.struct(F.collect_set("item_at").alias("at"), distinct("pairs").alias("pairs")).alias("all"),
        F.struct(F.collect_set(strict("item_at")).alias("at"), distinct(strict("pairs")).alias("pairs")).alias("strict"), F.max("told").alias("told")).where("told")
    size = lambda pairs, side: F.size(F.array_distinct(F.transform(pairs, lambda p: p[side])))
    fits = lambda pairs: (size(pairs, "item_fill") == F.size(pairs)) & (size(pairs, "doc_fill") == F.size(pairs))
    lines = lines.withColumn("line", F.when(fits(F.col("all.pairs")), F.col("all")).when(
        fits(F.col("strict.pairs")), F.col("strict"))).where("size(line.at) > 0").select(
        "doc_id", "item_id", "item_windows", "line.at", "line.pairs")
    whole = lines.groupBy("doc_id", "item_id", "item_windows").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("n_windows"),
        F.max(F.size("pairs")).alias("n_slots"),
        F.max(F.exists("pairs", lambda p: p["item_fill"] != p["doc_fill"])).alias("reparameterised"))
    return whole.withColumn("coverage", F.col("n_windows") / F.col("item_windows")).where(F.col("coverage") >= least).select(
        "doc_id", "item_id", F.col("n_windows").cast("long").alias("n_windows"), "coverage", "n_slots", "reparameterised")
