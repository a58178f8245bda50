"""Alignment of two tokenizers through an inverted index of linked token pairs.

Every text is cut by both tokenizers. Byte offsets where a token of either ends cut it into
groups; within a group every token of one is linked with every token of the other. The
index holds, per pair of ids, a compressed bitmap of the documents that link it, with planes for how often
(``bitmaps.py``). Documents are numbered within blocks of bounded size: a task ORs the bitmaps of its
chunks into those of a block, whose bits no other block shares, so a pair's documents are the sum of the popcounts of its
blocks. Counts come back to the lists, and the lists return them to the documents.

No row of documents and pairs is ever written out: a pair has at most one row per block, which also bounds
how many rows one pair can bring to a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.bitmaps import PLACE_BITS, PairLists, opened
from bandwise.llm.common import text_chunks, written
from bandwise.llm.packing import ByteBpe

#: A block ends at this many documents, or at about this many (pair, document) rows.
BLOCK_DOCS, BLOCK_ROWS = 1 << PLACE_BITS, 4_000_000
#: (pair, document) rows whose planes are made at once.
SLICE_ROWS = 250_000
#: Bytes of text that are cut and linked at once.
CHUNK_BYTES = 1_000_000
#: Groups with more links than this are linked through their distinct ids.
WIDE_GROUP = 1024
#: Places of the second tokenizer's ids in a pair's key.
ID_BITS = 24


class BytePieces:
    """Ids of a byte-level BPE file, and the bytes of each."""

    def __init__(self, path: str):
        self.tokenizer = ByteBpe(path, encode_special_tokens=True)
        self.bytes = self.tokenizer.token_bytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(self.tokenizer.encode(t), "<u4") for t in texts]


class SentencePieces:
    """Ids of a sentencepiece model, and the bytes of each."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.bytes = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(self.model.id_to_piece(list(range(size))))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.uint32) for x in self.model.encode(texts, num_threads=1)]


def _decimals(size: int, separators: tuple[str, ...]) -> pa.Array:
    """``id`` + separator for every id and separator, at id * len(separators) + place."""
    return pa.array([f"{i}{s}" for i in range(size) for s in separators], pa.string())


def _buffer(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ends (from 0) and bytes of an array that isn't a slice of another."""
    if not len(strings):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    return (np.frombuffer(strings.buffers()[1], np.int32)[:len(strings) + 1].astype(np.int64),
            np.frombuffer(strings.buffers()[2] or b"", np.uint8))


class Aligner:
    """Groups and links of chunks of texts."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.bytes_a, self.bytes_b = pa.array(a.bytes, pa.binary()), pa.array(b.bytes, pa.binary())
        self.text_a, self.text_b = _decimals(len(a.bytes), (",", "|")), _decimals(len(b.bytes), (",", ";"))

    def _encoded(self, side, table: pa.Array, sources: list[str], wanted: list[bytes]):
        """Ids of each text, their byte ends, and which texts their bytes spell."""
        ids = side.encode(sources)
        n = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        ends, data = _buffer(table.take(pa.array(flat.astype(np.int64))))
        edge = np.concatenate(([0], np.cumsum(n)))
        right = [data[ends[x]:ends[y]].tobytes() == w for x, y, w in zip(edge[:-1], edge[1:], wanted)]
        return ids, right

    def chunk(self, texts: list[str]):
        """Per text: n_a, n_b, n_groups, n_links, sha; and the links as (a, b, text, times)."""
        sources = [" " + t for t in texts]
        wanted = [s.encode() if t else b"\0" for s, t in zip(sources, texts)]  # b"\0": no tokens spell it
        ids_a, right_a = self._encoded(self.a, self.bytes_a, sources, wanted)
        ids_b, right_b = self._encoded(self.b, self.bytes_b, texts, wanted)
        good = [i for i, (t, x, y) in enumerate(zip(texts, right_a, right_b)) if t and x and y]
        n_a, n_b, n_groups, n_links = (np.zeros(len(texts), np.int64) for _ in range(4))
        sha = [""] * len(texts)
        if not good:
            return n_a, n_b, n_groups, n_links, sha, (np.zeros(0, np.int64),) * 4
        n_a[good], n_b[good] = [len(ids_a[i]) for i in good], [len(ids_b[i]) for i in good]
        a = np.concatenate([ids_a[i] for i in good]).astype(np.int64)
        b = np.concatenate([ids_b[i] for i in good]).astype(np.int64)
        # the texts laid end to end: byte ends grow over all of them, and every text's last is common
        end_a = _buffer(self.bytes_a.take(pa.array(a)))[0][1:]
        end_b = _buffer(self.bytes_b.take(pa.array(b)))[0][1:]
        cuts = np.intersect1d(end_a, end_b)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        in_a, in_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        text_of = np.repeat(good, n_a[good])[np.cumsum(in_a) - 1]  # of each group
        n_groups += np.bincount(text_of, minlength=len(texts))
        np.add.at(n_links, text_of, in_a * in_b)
        # the groups written out
        last_a = np.zeros(len(a), bool)
        last_b = np.zeros(len(b), bool)
        last_a[np.cumsum(in_a) - 1], last_b[np.cumsum(in_b) - 1] = True, True
        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
        pieces = pa.concat_arrays([self.text_a.take(pa.array(2 * a + last_a)), self.text_b.take(pa.array(2 * b + last_b))])
        ends, data = _buffer(pieces.take(pa.array(order)))
        edge = ends[np.concatenate(([0], np.cumsum((n_a + n_b)[good])))]
        for i, x, y in zip(good, edge[:-1], edge[1:]):
            sha[i] = hashlib.sha256(data[x:y - 1]).hexdigest()  # without the last separator
        # links: every token of a repeated for each of b in its group
        wide = in_a * in_b > WIDE_GROUP
        narrow = ~wide[group_a]
        times = in_b[group_a[narrow]]
        first_b = np.cumsum(in_b) - in_b
        at_b = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times) + np.repeat(
            first_b[group_a[narrow]], times)
        parts = [(np.repeat(a[narrow], times), b[at_b], np.repeat(text_of[group_a[narrow]], times), np.ones(len(at_b), np.int64))]
        first_a = np.cumsum(in_a) - in_a
        for g in np.flatnonzero(wide):
            x, m = np.unique(a[first_a[g]:first_a[g] + in_a[g]], return_counts=True)
            y, k = np.unique(b[first_b[g]:first_b[g] + in_b[g]], return_counts=True)
            parts.append((np.repeat(x, len(y)), np.tile(y, len(x)), np.full(len(x) * len(y), text_of[g]), np.outer(m, k).ravel()))
        return n_a, n_b, n_groups, n_links, sha, tuple(np.concatenate(p) for p in zip(*parts))


INDEX = ("block long, place int, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "a int, b int, n_docs long, planes array<binary>")


def _indexer(make_aligner):
    """Documents to index rows: those of documents (a, b null) and those of pairs (place null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = make_aligner()
        context = TaskContext.get()
        block = (context.partitionId() if context else 0) << 32
        lists: list[PairLists] = []
        place = rows = 0

        def pair_rows() -> Iterator[pa.RecordBatch]:
            for some in PairLists.merged(lists).slices(SLICE_ROWS):  # the planes of a stretch of keys at a time
                k, n, planes = some.planes(place)
                none = [pa.nulls(len(k), t) for t in (pa.int32(), doc_type, *(pa.int64(),) * 4, pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k), block)), *none, pa.array((k >> ID_BITS).astype(np.int32)),
                     pa.array((k & ((1 << ID_BITS) - 1)).astype(np.int32)), pa.array(n), planes], names)

        names = ["block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "n_docs", "planes"]
        doc_type = None
        for chunk in text_chunks(batches, chars=CHUNK_BYTES):
            doc_type = chunk.column(0).type
            for at in range(0, chunk.num_rows, 1024):
                part = chunk.slice(at, 1024)
                m = part.num_rows
                if place and (place + m > BLOCK_DOCS or rows >= BLOCK_ROWS):
                    yield from pair_rows()
                    lists, place, rows, block = [], 0, 0, block + 1
                *counts, sha, (a, b, text, times) = aligner.chunk([t or "" for t in part.column(1).to_pylist()])
                found = PairLists.counted((a << ID_BITS) | b, text + place, times if (times > 1).any() else None)
                lists.append(found)
                rows += len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, block)), pa.array(np.arange(place, place + m, dtype=np.int32)), part.column(0),
                     *(pa.array(c) for c in counts), pa.array(sha, pa.string()), pa.nulls(m, pa.int32()),
                     pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.binary()))], names)
                place += m
        if rows:
            yield from pair_rows()
    return run


def _returned(table: pa.Table) -> pa.Table:
    """One block: what its lists say about each of its documents."""
    table = table.combine_chunks()
    is_doc = pa.compute.is_valid(table["place"])
    docs, pairs = table.filter(is_doc), table.filter(pa.compute.invert(is_doc))
    places = np.asarray(docs["place"].combine_chunks() if docs.num_rows else pa.array([], pa.int32()))
    size = int(places.max(initial=-1)) + 1
    best, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for at in range(0, pairs.num_rows, 100_000):
        part = pairs.slice(at, 100_000).combine_chunks()
        column = {c: part[c].chunk(0) for c in ("planes", "count", "most")}
        row, place, weight = opened(column["planes"])
        count, most = np.asarray(column["count"]), np.asarray(column["most"])
        np.add.at(total, place, weight * count[row])
        np.add.at(best, place, weight * (count == most)[row])
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return out.append_column("n_best", pa.array(best[places])).append_column("count_sum", pa.array(total[places])).append_column(
        "groups_sha256", docs["groups_sha256"])


def align(docs: DataFrame, bpe_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    Tokenizer A is a byte-level BPE file and cuts space + text, B a sentencepiece model, which puts the space there itself;
    special tokens are plain text to both. A pair's count is the number of rows that link it; ``n_best``
    counts a row's links whose pair has the highest count of its A id, ties included, ``count_sum`` adds the counts of
    its links. Null and empty texts and those that either tokenizer doesn't spell byte for byte have zeros and
    an empty ``groups_sha256``. Repeated rows and rows with null or equal ids are rows of their own; an empty table gives no
    rows; other columns are ignored. Groups of any size are linked whole.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    index = written(slim.mapInArrow(
        _indexer(lambda: Aligner(BytePieces(bpe_path), SentencePieces(pieces_path))), INDEX.format(kind=kind)), "pair-index")
    lists = index.where("a is not null").select("block", "a", "b", "n_docs", "planes")
    counts = written(lists.groupBy("a", "b").agg(F.sum("n_docs").alias("count")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    scored = lists.drop("n_docs").join(counts.join(most, "a"), ["a", "b"])
    rows = index.where("a is null").select("block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return rows.unionByName(scored.select("block", "planes", "count", "most"), allowMissingColumns=True).groupBy(
        "block").applyInArrow(_returned, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                         "count_sum long, groups_sha256 string")
