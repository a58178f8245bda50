"""Harmonic packing of tokenised documents into fixed-capacity training sequences.

A document's ids are cut into whole sequences of ``capacity`` ids, then powers
of two down to ``min_piece``, then a rest below it. A piece of length n belongs
to the reciprocal class j = capacity // n, whose sequences take exactly j
pieces. The cuts make the large classes fill their sequences without a gap; a
sequence of class-j rests leaves fewer than n ids of padding.

Every task fills the classes of its own partition and never waits for another,
so there is no shuffle and nothing global. Pieces left at the end of a task, at most
j - 1 per class, are laid end to end; the last such sequence is
cut into powers of two, which need no padding.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import text_chunks

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, sequence_length long")
#: Sequence ids: partition number in the high bits, the task's own counter below.
COUNTER_BITS = 36

#: Fixed value: the pattern that ``tokenizers`` means by a file's plain byte-level pre-tokenizer.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in such a vocabulary file:
    itself where printable, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


#: Texts with a longer run of white space are left to ``tokenizers``: the other library's matcher gives up on it.
LONG_RUN = 50_000
_LONG_RUN = re.compile(r"\s{%d}" % LONG_RUN)


class ByteBpe:
    """Ids of whole texts under a byte-level BPE file of ``tokenizers``.

    The ids equal those of that library for the same file and setting of
    ``encode_special_tokens`` (the tests compare them): if false, as the library loads
    the file, the file's added tokens within a text are one id each, else they
    are cut like other text. ``tiktoken`` merges by the file's own ranks. ``tokenizers`` itself cuts texts
    that hold an added token which must stay whole, texts with very long runs of white space,
    and all texts if the file asks for more than the plain byte-level form.
    """

    def __init__(self, path: str, encode_special_tokens: bool = True):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", [])}
        self.vocab = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec.get("added_tokens", [])}}
        self.special = special
        to_byte = {c: b for b, c in _byte_alphabet().items()}
        self.to_byte = to_byte
        self.loaded = Tokenizer.from_file(path)
        self.loaded.encode_special_tokens = encode_special_tokens
        self.added = () if encode_special_tokens else tuple(special)
        before = spec.get("pre_tokenizer") or {}
        plain = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
                 and spec.get("normalizer") is None and not spec["model"].get("ignore_merges")
                 and not any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")))
        self.core = None
        if plain:
            ranks = {bytes(to_byte[c] for c in token): i
                     for token, i in spec["model"]["vocab"].items() if token not in special}
            self.core = tiktoken.Encoding("from_file", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})

    def token_bytes(self) -> list[bytes]:
        """The bytes that each id stands for (none for unused ids)."""
        out = [b""] * (max(self.vocab.values(), default=-1) + 1)
        for token, i in self.vocab.items():
            out[i] = token.encode() if token in self.special else bytes(self.to_byte[c] for c in token)
        return out

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.core is None or any(token in text for token in self.added) or (
                len(text) > LONG_RUN and _LONG_RUN.search(text)):
            return np.array(self.loaded.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.core.encode_to_numpy(text).astype("<u4").tobytes() if text else b""


def _cuts(n: int, capacity: int, min_piece: int) -> list[tuple[int, int]]:
    """(start, length) pieces of a document with n ids."""
    out, at = [], 0
    while n - at >= capacity:
        out.append((at, capacity))
        at += capacity
    size = capacity // 2
    while size >= min_piece:
        if n - at >= size:
            out.append((at, size))
            at += size
        size //= 2
    if n > at:
        out.append((at, n - at))
    return out


def _packer(path: str, capacity: int, min_piece: int, end_id: int, encode_special_tokens: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = ByteBpe(path, encode_special_tokens)
        end = np.array([end_id], "<u4").tobytes()
        context = TaskContext.get()
        seq = (context.partitionId() if context else 0) << COUNTER_BITS
        waiting: dict[int, list] = {}
        rows: list[tuple] = []

        def emit(pieces):
            nonlocal seq
            total, at = sum(len(p[2]) for p in pieces) // 4, 0
            for doc, start, ids, n in pieces:
                rows.append((doc, start, len(ids) // 4, ids, n, seq, at, total))
                at += len(ids) // 4
            seq += 1

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(),
                    pa.int64(), pa.int64()))],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset",
                 "sequence_length"])
            rows.clear()
            return out

        for chunk in text_chunks(batches):
            docs = chunk.column(0).to_pylist()
            texts = [t or "" for t in chunk.column(1).to_pylist()]
            for doc, text in zip(docs, texts):
                ids = tok.encode(text) + end
                n = len(ids) // 4
                for start, length in _cuts(n, capacity, min_piece):
                    piece = (doc, start, ids[4 * start:4 * (start + length)], n)
                    j = capacity // length
                    if j == 1:
                        emit([piece])
                        continue
                    bin_ = waiting.setdefault(length if length < min_piece else -j, [])
                    bin_.append(piece)
                    if len(bin_) == j:
                        emit(bin_)
                        bin_.clear()
            if rows:
                yield flush()
        # what is left of each class, laid end to end and cut at the capacity
        room, current = capacity, []
        rest = [p for key in sorted(waiting) for p in waiting[key]]
        left = sum(len(p[2]) for p in rest) // 4

        def next_room():  # a full sequence, or else the largest power of two that fills
            return capacity if left >= capacity else 1 << max(left.bit_length() - 1, 0)

        room = next_room()
        for doc, start, ids, n in rest:
            while ids:
                take = min(room, len(ids) // 4)
                current.append((doc, start, ids[:4 * take], n))
                ids, start = ids[4 * take:], start + take
                room, left = room - take, left - take
                if not room:
                    emit(current)
                    current = []
                    room = next_room()
        if rows:
            yield flush()

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                   text_col: str = "text", capacity: int = 1024, min_piece: int = 32,
                   end_id: int = 0, encode_special_tokens: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset, sequence_length.

    ``ids`` holds little-endian unsigned 32-bit token ids; every document ends
    with ``end_id``. ``encode_special_tokens`` is the setting of that name in ``tokenizers``:
    false, as that library loads a file, keeps the file's added tokens in a text whole. Null and empty texts are that id alone. Rows are packed
    one by one, so repeated rows and null ids are packed like any other; an
    empty table gives no rows. Other columns are ignored. A sequence of
    ``sequence_length`` ids is padded to ``capacity`` by the reader unless its
    length is a power of two. Tasks that are run again give the same sequences.
    """
    if capacity & (capacity - 1) or min_piece & (min_piece - 1) or not 1 <= min_piece <= capacity:
        raise ValueError("capacity and min_piece must be powers of two, min_piece at most capacity")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_packer(tokenizer_path, capacity, min_piece, end_id, encode_special_tokens), PIECES)
