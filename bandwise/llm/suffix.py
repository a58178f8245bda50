"""Repeated byte strings across documents, by per-shard suffix arrays.

A byte goes if it lies in a string of ``length`` bytes that also starts in a document with a
smaller id. The work is dealt so that equal strings meet without shipping every suffix:

1. Of equal texts only the one of the smallest id takes part; the others go whole.
2. Each string has an anchor, the least of its k-mers by hash: equal strings have equal anchors. Blocks of
   texts send each hash once, as 32 bits, to its bucket, which tells them the hashes that several blocks
   hold. The bytes around shared anchors (all strings that one anchor stands for) go to shards by
   anchor hash; of equal contexts in a step only that of the smallest id goes, the
   others are repeats already.
3. A shard builds the suffix array of its contexts by Larsson-Sadakane refinement and the common prefixes
   by Kasai's method; suffixes with ``length`` common bytes are one string, whose smallest id
   decides. A list of contexts too long for one shard spans several; their sorted strings are merged
   by binary search.
4. The intervals found are joined with the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import text_chunks
from bandwise.llm.shingles import _BASE, _DOWN, _UP, _VALUE, mix

KMER = 24
#: Bytes of text in a step of a task (positions must fit beside a hash in 64 bits).
STEP = 1 << 20
_POSITION_BITS = np.uint64(21)
#: Bytes of text in a block of anchor records, which has at most 65,536 texts.
BLOCK = 16 << 20
#: Bytes of contexts in a shard.
SHARD = 1 << 20


# ---- anchors -------------------------------------------------------------------------------

def anchors(data: np.ndarray, breaks: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(anchor position, its hash, first and last string start it stands for) of all strings of
    ``length`` bytes in ``data`` that don't cross one of ``breaks`` (ends of texts)."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    n = len(data)
    if n < length:
        return none
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * _UP[:n], dtype=np.uint64, out=total[1:])
    hashes = mix((total[KMER:] - total[:-KMER]) * _DOWN[:n - KMER + 1])
    width = length - KMER + 1
    low = (hashes >> _POSITION_BITS << _POSITION_BITS) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    low = np.minimum(low[:len(low) - rest], low[rest:])
    chosen = (low & np.uint64((1 << int(_POSITION_BITS)) - 1)).astype(np.int64)
    crossing = np.zeros(n + 1, np.int64)  # strings that start within length - 1 before a break
    for b in breaks:
        crossing[max(b - length + 1, 0)] += 1
        crossing[b] -= 1
    inside = np.flatnonzero(np.cumsum(crossing)[:len(chosen)] == 0)
    if not len(inside):
        return none
    at = chosen[inside]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 0) | (np.diff(inside) != 1))))
    first, last = inside[new], inside[np.concatenate((new[1:], [len(inside)])) - 1]
    return at[new], hashes[at[new]], first, last


def steps(chunk: pa.RecordBatch, length: int):
    """(bytes, breaks, row of each text, its start in the bytes, its offset) of a chunk, in pieces of
    at most about STEP bytes; the pieces of a longer text overlap by length - 1 bytes."""
    parts, rows, starts, offsets, size = [], [], [], [], 0

    def done():
        data = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.cumsum([len(p) for p in parts])
        return data, ends, np.array(rows), np.array(starts), np.array(offsets)

    for row, text in enumerate(chunk.column(2).to_pylist()):
        raw = text or b""
        for at in range(0, max(len(raw) - length + 1, 0), STEP - length):
            piece = raw[at:at + STEP - 1]
            if size and size + len(piece) > STEP:
                yield done()
                parts, rows, starts, offsets, size = [], [], [], [], 0
            parts.append(piece)
            rows.append(row)
            starts.append(size)
            offsets.append(at)
            size += len(piece)
    if parts:
        yield done()


def _short(hashes: np.ndarray) -> np.ndarray:
    """The 32 bits that stand for an anchor hash within its bucket. Two hashes that share them cost a
    needless context, no more: strings are compared whole."""
    return (hashes >> np.uint64(32)).astype("<u4")


def _records(length: int, buckets: int):
    schema = ["bucket", "block", "hashes", "rows", "told", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchor hashes of blocks of about BLOCK bytes of text, one record a block and bucket."""
        task, blocks = TaskContext.get().partitionId(), 0
        hashes, at_row, names, size = [], [], [], 0

        def done():
            nonlocal blocks, size
            block = (task << 32) + blocks
            h, row, docs = np.concatenate(hashes), np.concatenate(at_row), np.array(names, "<i8")
            tag = docs[row, 1]
            order = np.lexsort((docs[row, 0], tag, h))  # of equal texts the smallest id is told
            hs, ts = h[order], tag[order]
            head = np.concatenate(([True], hs[1:] != hs[:-1]))
            firsts = np.flatnonzero(head)
            several = ts[firsts] != ts[np.concatenate((firsts[1:], [len(hs)])) - 1]
            known = np.zeros(len(h), bool)  # shared already: no bucket need say so
            known[order] = several[np.cumsum(head) - 1]
            out = [(-1 - block % buckets, block, _short(h[known]).tobytes(), row[known].tobytes(), b"", docs.tobytes())]
            send, told = order[firsts], several
            lane = (h[send] % np.uint64(buckets)).astype(np.int64)
            by = np.lexsort((send, lane))
            send, told, lane = send[by], told[by], lane[by]
            cuts = np.flatnonzero(np.concatenate(([True], np.diff(lane) != 0, [True])))
            for a, b in zip(cuts[:-1], cuts[1:]):
                gaps = np.diff(row[send[a:b]], prepend=np.uint16(0)).astype("<u2")
                out.append((int(lane[a]), block, _short(h[send[a:b]]).tobytes(), gaps.tobytes(),
                            told[a:b].astype(np.uint8).tobytes(), None))
            blocks, size = blocks + 1, 0
            for kept in (hashes, at_row, names):
                kept.clear()
            kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], schema)

        for chunk in text_chunks(batches, 2, STEP):
            ids, tags = chunk.column(0).to_pylist(), chunk.column(1).to_pylist()
            for data, breaks, rows, starts, _ in steps(chunk, length):
                if hashes and (size + len(data) > BLOCK or len(names) + len(rows) > 1 << 16):
                    yield done()
                at, h, _, _ = anchors(data, breaks, length)
                if not len(at):
                    continue
                at_row.append((np.searchsorted(starts, at, "right") - 1 + len(names)).astype("<u2"))
                hashes.append(h)
                names += [(ids[r], tags[r]) for r in rows.tolist()]
                size += len(data)
        if hashes:
            yield done()
    return run


def _shared(table: pa.Table) -> pa.Table:
    """Of a bucket: the hashes that several blocks hold, told to each of these blocks."""
    if table["bucket"][0].as_py() < 0:
        return table.select(["block", "hashes", "rows", "docs"])
    read = lambda c, kind: [np.frombuffer(x, kind) for x in table[c].to_pylist()]
    parts = read("hashes", "<u4")
    sizes = [len(x) for x in parts]
    h, told = np.concatenate(parts), np.concatenate(read("told", np.uint8))
    row = np.concatenate([np.cumsum(x, dtype="<u2") for x in read("rows", "<u2")])
    order = np.argsort(h, kind="stable")
    head = np.concatenate(([True], np.diff(h[order]) != 0))
    firsts = np.flatnonzero(head)
    several = (np.diff(np.concatenate((firsts, [len(h)]))) > 1) | (np.maximum.reduceat(told[order], firsts) > 0)
    keep = np.zeros(len(h), bool)
    keep[order] = several[np.cumsum(head) - 1]
    keep &= told == 0  # the block has passed on the others itself
    out, end = [], np.cumsum(sizes)
    for block, a, b in zip(table["block"].to_pylist(), (end - sizes).tolist(), end.tolist()):
        if keep[a:b].any():
            out.append((block, h[a:b][keep[a:b]].tobytes(), row[a:b][keep[a:b]].tobytes(), None))
    kinds = [("block", pa.int64()), ("hashes", pa.binary()), ("rows", pa.binary()), ("docs", pa.binary())]
    return pa.table([pa.array([o[i] for o in out], k) for i, (_, k) in enumerate(kinds)], schema=pa.schema(kinds))


def _by_text(table: pa.Table) -> pa.Table:
    """Shared hashes of each text of a block."""
    docs = np.concatenate([np.frombuffer(x, "<i8") for x in table["docs"].to_pylist() if x is not None]).reshape(-1, 2)
    h = np.concatenate([np.frombuffer(x, "<u4") for x in table["hashes"].to_pylist()])
    row = np.concatenate([np.frombuffer(x, "<u2") for x in table["rows"].to_pylist()])
    order = np.argsort(row, kind="stable")
    h, cuts = h[order], np.searchsorted(row[order], np.arange(len(docs) + 1))
    some = np.flatnonzero(np.diff(cuts))
    return pa.table([pa.array(docs[some, 0], pa.int64()), pa.array(docs[some, 1], pa.int64()),
                     pa.array([np.unique(h[cuts[i]:cuts[i + 1]]).tobytes() for i in some.tolist()], pa.binary())],
                    names=["doc_id", "tag", "hashes"])


# ---- contexts ------------------------------------------------------------------------------

def _contexts(length: int):
    names = ["anchor", "doc_id", "tag", "start", "context", "stop"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Contexts of shared anchors (stop null), and intervals that repeat within the step (context null)."""
        for chunk in text_chunks(batches, 2, STEP):
            ids, tags = np.asarray(chunk.column(0)), np.asarray(chunk.column(1))
            shared = [np.frombuffer(b"".join(x), "<u4") for x in chunk.column(3).to_pylist()]
            for data, breaks, rows, starts, offsets in steps(chunk, length):
                at, h, first, last = anchors(data, breaks, length)
                if not len(at):
                    continue
                piece = np.searchsorted(starts, at, "right") - 1
                shift = offsets[piece] - starts[piece]
                short, cuts = _short(h), np.searchsorted(piece, np.arange(len(rows) + 1))
                keep = np.concatenate([np.isin(short[lo:hi], shared[r]) for r, lo, hi in zip(rows, cuts[:-1], cuts[1:])])
                raw, seen, out = data.tobytes(), {}, []
                pick = np.flatnonzero(keep)
                pick = pick[np.argsort(ids[rows[piece[pick]]], kind="stable")]
                for i in pick.tolist():
                    row = rows[piece[i]]
                    context = raw[first[i]:last[i] + length]
                    begin = int(first[i] + shift[i])
                    before = seen.setdefault((context, int(at[i] - first[i])), ids[row])
                    if before < ids[row]:
                        out.append((None, ids[row], tags[row], begin, None, begin + len(context)))
                    else:
                        out.append((int(h[i].view(np.int64)), ids[row], tags[row], begin, context, None))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
    return run, ("anchor long, doc_id long, tag long, start long, context binary, stop long")


# ---- suffix arrays -------------------------------------------------------------------------

def suffix_array(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffixes of texts laid end to end, in order; a suffix stops at the end of its text (``ends``
    gives it for each position), and equal ones stand in text order.

    Larsson-Sadakane: sorted by seven bytes, then every group of equal rank is refined by the
    ranks that lie as far ahead as is sorted so far, which doubles that length.
    """
    n = len(data)
    position = np.arange(n)
    padded = np.concatenate((data.astype(np.uint64) + np.uint64(1), np.zeros(7, np.uint64)))
    key = np.zeros(n, np.uint64)
    for i in range(7):  # nine bits hold a byte or the end
        key = (key << np.uint64(9)) | np.where(position + i < ends, padded[i:i + n], np.uint64(0))
    order = np.argsort(key, kind="stable")
    heads = np.concatenate(([True], np.diff(key[order]) != 0))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(heads, position, 0))
    h, longest, wide = 7, int((ends - position).max(initial=0)), np.int64(n + 1)
    open_ = position
    while h < longest:
        starts = np.flatnonzero(heads[open_])  # of groups; those of one suffix are done
        sizes = np.diff(np.concatenate((starts, [len(open_)])))
        open_ = open_[np.repeat(sizes > 1, sizes)]
        if not len(open_):
            break
        these = order[open_]
        far = these + h
        key = rank[these] * wide + np.where(far < ends[these], rank[np.minimum(far, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")  # ties stay in text order
        order[open_], key = these[by], key[by]
        heads[open_] = np.concatenate(([True], np.diff(key) != 0))
        rank[order[open_]] = np.maximum.accumulate(np.where(heads[open_], open_, 0))
        h *= 2
    return order


def common_prefixes(data: np.ndarray, ends: np.ndarray, order: np.ndarray, cap: int,
                    lanes: int = 8192) -> np.ndarray:
    """Common prefix, up to ``cap``, of each suffix in order with the one before it.

    Kasai: in text order a prefix is at most one byte shorter than the last one. The texts are cut into
    lanes that take this walk side by side.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    found = np.zeros(n, np.int32)
    lanes = max(1, min(lanes, n // 64 + 1))
    width = -(-n // lanes)
    position = np.arange(lanes) * width
    h = np.zeros(lanes, np.int64)
    for step in range(width):
        i = position + step
        live = np.flatnonzero(i < np.minimum(position + width, n))
        i = i[live]
        j = before[i]
        most = np.where(j >= 0, np.minimum(np.minimum(ends[i] - i, ends[j] - j), cap), 0)
        k = np.minimum(np.maximum(h[live] - 1, 0), most)
        going = np.flatnonzero(k < most)
        while len(going):
            going = going[data[i[going] + k[going]] == data[j[going] + k[going]]]
            k[going] += 1
            going = going[k[going] < most[going]]
        found[i] = k
        h[live] = k
    return found[order]


def repeated_starts(contexts: list[bytes], docs: np.ndarray, length: int):
    """Of one shard: (context, start in it, smallest id) of every string of ``length`` bytes.

    Returned in suffix order, with a group number: equal numbers are equal strings.
    """
    sizes = np.array([len(c) for c in contexts])
    data = np.frombuffer(b"".join(contexts), np.uint8)
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    owner = np.repeat(np.arange(len(contexts)), sizes)
    ends = (begins + sizes)[owner]
    order = suffix_array(data, ends)
    shared = common_prefixes(data, ends, order, length)
    inner = order - begins[owner[order]]
    full = inner + length <= sizes[owner[order]]
    group = np.cumsum(shared < length)
    least = np.full(group[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group[full], docs[owner[order[full]]])
    return owner[order[full]], inner[full], group[full], least[group[full]]


def _strings(contexts: list[bytes], owner: np.ndarray, inner: np.ndarray, length: int) -> np.ndarray:
    """The strings themselves; the last byte keeps trailing zero bytes in the comparison."""
    return np.array([contexts[o][i:i + length] + b"\x01" for o, i in zip(owner, inner)], f"S{length + 1}")


def _shards(length: int):
    def solve(rows: list[tuple], carried: dict) -> tuple[list[tuple], dict]:
        """Intervals of one shard; ``carried`` holds the sorted strings of a list of contexts that began
        in an earlier shard, with the smallest id of each."""
        contexts, docs = [r[3] for r in rows], np.array([r[1] for r in rows], np.int64)
        owner, inner, _, least = repeated_starts(contexts, docs, length)
        anchor = np.array([r[0] for r in rows], np.int64)
        if carried:
            again = np.flatnonzero(anchor[owner] == carried["anchor"])
            if len(again):
                mine = _strings(contexts, owner[again], inner[again], length)
                at = np.minimum(np.searchsorted(carried["strings"], mine), len(carried["strings"]) - 1)
                hit = carried["strings"][at] == mine
                least[again[hit]] = np.minimum(least[again[hit]], carried["least"][at[hit]])
        gone = least < docs[owner]
        by = np.lexsort((inner[gone], owner[gone]))
        o, s = owner[gone][by], inner[gone][by]
        out = []
        if len(o):
            new = np.flatnonzero(np.concatenate(([True], (np.diff(o) != 0) | (np.diff(s) > length))))
            ends = np.concatenate((new[1:], [len(o)])) - 1
            out = [(rows[a][1], rows[a][2], rows[a][4] + b, rows[a][4] + c + length)
                   for a, b, c in zip(o[new].tolist(), s[new].tolist(), s[ends].tolist())]
        last = anchor[-1]
        here = np.flatnonzero(anchor[owner] == last)
        strings, least = _strings(contexts, owner[here], inner[here], length), least[here]
        if carried and carried["anchor"] == last:
            strings, least = np.concatenate((carried["strings"], strings)), np.concatenate((carried["least"], least))
        by = np.lexsort((least, strings))
        strings, least = strings[by], least[by]
        first = np.concatenate(([True], strings[1:] != strings[:-1])) if len(strings) else np.zeros(0, bool)
        return out, {"anchor": last, "strings": strings[first], "least": least[first]} if first.any() else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, carried = [], 0, {}

        def emit(found):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)],
                                              ["doc_id", "tag", "start", "stop"])

        def close():
            """The contexts of an anchor that has several; one alone repeats nowhere else."""
            nonlocal size
            if len(seen) > 1 or rows and rows[-1][0] == anchor:
                rows.extend(group)
                size += sum(len(r[3]) for r in group)
            group.clear()

        anchor, seen, group, found = None, {}, [], []
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("anchor", "doc_id", "tag", "context", "start", "stop"))):
                if row[3] is None:  # an interval that is known already
                    found.append((row[1], row[2], row[4], row[5]))
                    continue
                if row[0] != anchor:
                    close()
                    if size >= SHARD:
                        found += solve(rows, carried)[0]
                        rows, size, carried = [], 0, {}
                    anchor, seen = row[0], {}
                first = seen.setdefault(row[3], row[1])
                if first < row[1]:
                    found.append((row[1], row[2], row[4], row[4] + len(row[3])))
                else:
                    group.append(row)
                    if len(group) % 4096 == 0:  # a long list of contexts: what there is of it makes a shard
                        close()
                        if size >= SHARD:
                            more, carried = solve(rows, carried)
                            found += more
                            rows, size = [], 0
                if len(found) >= 10_000:
                    yield emit(found)
                    found = []
        close()
        if rows:
            found += solve(rows, carried)[0]
        if found:
            yield emit(found)
    return run


# ---- the whole -----------------------------------------------------------------------------

def _cut(length: int):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, 1):
            out = []
            for doc, raw, found, first in zip(*(c.to_pylist() for c in chunk.columns)):
                spans = []
                for r in sorted((r["start"], r["stop"]) for r in found or []):
                    if spans and r[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r[1])
                    else:
                        spans.append(list(r))
                if not first and doc is not None and len(raw) >= length:
                    spans = [[0, len(raw)]]  # a text that a smaller id has as well
                kept, at = [], 0
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                kept.append(raw[at:])
                kept = b"".join(kept)
                out.append((doc, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes left) of every row.

    Texts are UTF-8 bytes, null ones empty. Rows with a null id neither lose bytes nor make others lose any. Rows with equal
    ids don't count against each other; rows repeated whole all lose the same bytes. Texts
    shorter than ``length`` lose nothing. An empty table gives no rows; other columns are ignored.
    """
    if not KMER < length <= 120:
        raise ValueError(f"length must be above {KMER} and at most 120")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    slim = docs.select(F.col(id_col).cast("long").alias("row_id"), text.alias("raw"))
    total = slim.agg(F.sum(F.length("raw"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (128 << 20))
    # the texts are shuffled once: both joins below read this same exchange (a column renamed for sure on
    # both sides: a redundant alias goes on one side only, and the exchanges would differ)
    texts = slim.where("row_id is not null").select("row_id", F.xxhash64("raw").alias("tag"), "raw")
    firsts = texts.where(F.length("raw") >= length).groupBy(
        "tag", F.xxhash64(F.lit(1), "raw").alias("tag2")).agg(F.min("row_id").alias("doc_id")).select(
        "doc_id", "tag", F.lit(True).alias("first"))
    records = texts.mapInArrow(_records(length, buckets), "bucket long, block long, hashes binary, rows binary, "
                               "told binary, docs binary")
    shared = records.groupBy("bucket").applyInArrow(
        _shared, "block long, hashes binary, rows binary, docs binary").groupBy("block").applyInArrow(
        _by_text, "doc_id long, tag long, hashes binary")
    marked = shared.unionByName(firsts, allowMissingColumns=True).groupBy("doc_id", "tag").agg(
        F.collect_list("hashes").alias("hashes"), F.max("first").alias("first")).where(
        F.col("first") & (F.size("hashes") > 0)).select(F.col("doc_id").alias("row_id"), "tag", "hashes")
    run, kind = _contexts(length)
    pieces = texts.join(marked, ["row_id", "tag"]).select("row_id", "tag", "raw", "hashes").mapInArrow(run, kind)
    # intervals without an anchor travel by document, so that they don't meet in one task
    route = F.coalesce("anchor", F.xxhash64("doc_id"))
    found = pieces.withColumn("route", route).repartition("route").sortWithinPartitions("anchor", "doc_id").drop(
        "route").mapInArrow(_shards(length), "doc_id long, tag long, start long, stop long")
    spans = found.select("doc_id", "tag", F.struct("start", "stop").alias("span")).unionByName(
        firsts, allowMissingColumns=True).groupBy("doc_id", "tag").agg(
        F.collect_set("span").alias("found"), F.max("first").alias("first")).withColumnRenamed("doc_id", "row_id")
    named = texts.join(spans, ["row_id", "tag"], "left").select("row_id", "raw", "found", "first")
    unnamed = slim.where("row_id is null").select("row_id", "raw", F.lit(None).cast(named.schema["found"].dataType).alias(
        "found"), F.lit(True).alias("first"))
    return named.unionByName(unnamed).mapInArrow(
        _cut(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
