"""Cross-tokenizer alignment against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from bandwise.llm import alignment
from bandwise.llm.bitmaps import PairLists, opened
from bandwise.llm.queries import pieces_path, tokenizer_path

SCHEMA = "doc_id long, text string, a int, count string, place int, planes string"


def byte_alphabet():
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def brute_force(rows):
    """The contract, text by text, with the libraries as they are."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(tokenizer_path())
    bpe.encode_special_tokens = True
    to_byte, model = byte_alphabet(), SentencePieceProcessor(model_file=pieces_path())

    def spelled(piece):
        if len(piece) == 6 and piece.startswith("<0x"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    docs, holders = [], defaultdict(set)
    for at, (doc, text) in enumerate(rows):
        a = bpe.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        bytes_a = [bytes(to_byte[c] for c in bpe.id_to_token(i)) for i in a]
        bytes_b = [spelled(model.id_to_piece(i)) for i in b]
        want = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            docs.append((doc, 0, 0, 0, Counter(), ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        groups, low_a, low_b = [], 0, 0
        for cut in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            high_a, high_b = int(np.searchsorted(ends_a, cut)) + 1, int(np.searchsorted(ends_b, cut)) + 1
            groups.append((a[low_a:high_a], b[low_b:high_b]))
            low_a, low_b = high_a, high_b
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        for pair in links:
            holders[pair].add(at)
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        docs.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(said.encode()).hexdigest()))
    count = {p: len(h) for p, h in holders.items()}
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return [(doc, n_a, n_b, n, sum(links.values()), sum(m for p, m in links.items() if count[p] == most[p[0]]),
             sum(m * count[p] for p, m in links.items()), sha) for doc, n_a, n_b, n, links, sha in docs]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["the", "tokenisation", "naïve", "Straße", "東京都", "x=1;", "<|endoftext|>", "<s>", "12345", "don't", "🙂👍🏽", "ﬁ"]
    texts = [None, "", " ", "a", "\n\n\t", "  two  spaces ", "▁real", "nul\0byte", "<0x41>", "�", " " * 700, "ab" * 900,
             "=" * 4000, "日本語" * 400, "é" * 50]
    texts += [" ".join(rng.choices(words, k=rng.randrange(1, 60))) for _ in range(60)]
    texts += [" ".join(rng.choices(words, k=9000))]
    return list(enumerate(texts)) + [(3, "a"), (None, "the tokenisation"), (None, None)]


def found(spark, rows, parts=3):
    df = spark.createDataFrame([(i, t, 1, "c", 2, "p") for i, t in rows], SCHEMA).repartition(parts)
    return [tuple(r) for r in alignment.align(df, tokenizer_path(), pieces_path()).collect()]


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_alignment_equals_brute_force(spark, rows):
    assert by_id(found(spark, rows)) == by_id(brute_force(rows))


def test_small_blocks_and_wide_groups_change_nothing(spark, rows):
    aligner = alignment.Aligner(alignment.BytePieces(tokenizer_path()), alignment.SentencePieces(pieces_path()))
    texts = [t or "" for _, t in rows]
    *counts, sha, links = aligner.chunk(texts)
    wide, alignment.WIDE_GROUP = alignment.WIDE_GROUP, 0
    try:
        *again, sha2, links2 = aligner.chunk(texts)
    finally:
        alignment.WIDE_GROUP = wide
    assert sha == sha2 and all((x == y).all() for x, y in zip(counts, again))
    first, second = (PairLists.counted((a << alignment.ID_BITS) | b, t, n) for a, b, t, n in (links, links2))
    assert (first.keys == second.keys).all() and (first.places == second.places).all() and (first.times == second.times).all()
    # blocks of a few rows: the indexer run by hand, its pair rows added up
    small, alignment.BLOCK_ROWS = alignment.BLOCK_ROWS, 50
    try:
        docs = pa.record_batch([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())],
                               ["doc_id", "text"])
        parts = list(alignment._indexer(lambda: aligner)(iter([docs.slice(i, 5) for i in range(0, len(rows), 5)])))
    finally:
        alignment.BLOCK_ROWS = small
    index = pa.Table.from_batches(parts).to_pandas()
    pairs = index[index.a.notna()]
    assert index.block.nunique() > 5
    holders = Counter()
    for key in first.keys.tolist():
        holders[key >> alignment.ID_BITS, key & ((1 << alignment.ID_BITS) - 1)] += 1
    assert pairs.groupby(["a", "b"]).n_docs.sum().to_dict() == dict(holders)


def test_alignment_of_nothing(spark):
    assert found(spark, [], 1) == []
    assert found(spark, [(1, None)], 1) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_a_very_long_text(spark):
    text = "word " * 60_000 + " " * 120_000 + "z" * 100_000
    rows = [(1, text), (2, "word")]
    assert by_id(found(spark, rows, 1)) == by_id(brute_force(rows))


def test_lists_come_back_as_they_were_stored():
    rng = np.random.default_rng(1)
    for n_places in (1, 9, 300, 60_000):
        keys = np.concatenate([rng.integers(0, 50, 3000), np.full(4000, 7)])
        places = rng.integers(0, n_places, len(keys))
        lists = PairLists.counted(keys, places)
        halves = PairLists.merged([PairLists.counted(keys[i::2], places[i::2]) for i in (0, 1)])
        assert (lists.keys == halves.keys).all() and (lists.times == halves.times).all()
        distinct, n, planes = lists.planes(n_places)
        row, place, weight = opened(planes)
        times = Counter()
        for r, p, w in zip(distinct[row].tolist(), place.tolist(), weight.tolist()):
            times[r, p] += w
        assert times == Counter(zip(keys.tolist(), places.tolist()))
        assert n.tolist() == [len(set(places[keys == k].tolist())) for k in distinct]


def test_a_block_of_lists_stays_small_in_memory():
    """A block of a million (pair, document) rows: every pair comes back once, and no step holds many bytes a row."""
    import tracemalloc

    class Links:
        rng = np.random.default_rng(4)

        def chunk(self, texts):
            n = len(texts)
            rng = self.rng
            a = rng.integers(0, 4000, 1000 * n)
            zero = np.zeros(n, np.int64)
            links = (a, rng.integers(0, 50, len(a)), np.repeat(np.arange(n), 1000), np.where(a == 7, 300, 1))
            return zero, zero, zero, zero, [""] * n, links

    docs = pa.record_batch([pa.array(range(1000), pa.int64()), pa.array(["x"] * 1000)], ["doc_id", "text"])
    tracemalloc.start()
    pairs = rows = 0
    for b in alignment._indexer(Links)(iter([docs.slice(i, 100) for i in range(0, 1000, 100)])):
        if b.column("place").null_count:
            pairs, rows = pairs + b.num_rows, rows + sum(b.column("n_docs").to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pairs > 190_000 and rows > 900_000
    assert peak < 120 << 20
