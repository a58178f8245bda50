"""Subword lattice scores against enumerated segmentations."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bandwise.llm import lattice
from bandwise.llm.queries import pieces_path

SCHEMA = "doc_id long, text string, train boolean, word string, count int, place int, at string"


def segmentations(s, pieces):
    if not s:
        yield []
    for n in range(1, len(s) + 1):
        if s[:n] in pieces:
            for rest in segmentations(s[n:], pieces):
                yield [s[:n], *rest]


@pytest.fixture(scope="module")
def small():
    strings = [b" ", b" a", b" ab", b"a", b"b", b"ab", b"ba", b"aba", b" b", b"bb", b"\xc3", b"\xa9", b"\xc3\xa9"]
    p = np.random.default_rng(2).dirichlet(np.ones(len(strings) + 1))
    return strings, p, lattice.Lattice(lattice.Pieces(strings), np.log(p[:-1]), math.log(p[-1]))


def test_words_equal_enumerated_segmentations(small):
    strings, p, model = small
    weight = dict(zip(strings, p))
    rng = random.Random(1)
    words = [b"", b"a", b"abab", b"\xc3\xa9a", b"zz", b"azb"] + [
        "".join(rng.choices("abé", k=rng.randrange(1, 10))).encode() for _ in range(60)]
    rate = np.arange(1.0, len(words) + 1)
    expected = np.zeros(len(strings) + 1)
    logs = model.words(words, lambda x, rows: rate[rows], expected)
    wanted, counts = [], np.zeros(len(strings) + 1)
    for w, r in zip(words, rate):
        paths = list(segmentations(b" " + w, weight)) if w else [[]]
        shares = [math.prod(weight[s] for s in path) for path in paths]
        wanted.append(sum(shares) * p[-1])
        counts[-1] += r
        for path, share in zip(paths, shares):
            for s in path:
                counts[strings.index(s)] += r * share / sum(shares)
    assert np.allclose(np.exp(logs), wanted, rtol=1e-12, atol=0)
    assert np.allclose(expected, counts, rtol=1e-10)


def test_long_words_and_small_steps_change_nothing(small):
    strings, _, model = small
    words = [b"ab" * 300, b"ba", b"a" * 4000, b"", b"ab" * 20]

    def run():
        expected = np.zeros(len(strings) + 1)
        return model.words(words, lambda x, rows: np.ones(len(rows)), expected), expected

    one, step = run(), lattice.STEP
    long_word, lattice.LONG_WORD, lattice.STEP = lattice.LONG_WORD, 1 << 20, 8
    try:
        two = run()
    finally:
        lattice.LONG_WORD, lattice.STEP = long_word, step
    assert np.allclose(one[0], two[0], rtol=1e-12) and np.allclose(one[1], two[1], rtol=1e-9)
    assert np.isfinite(one[0]).all()


def test_all_words_together_have_a_probability_of_at_most_one(small):
    strings, _, _ = small
    model = lattice.Lattice(lattice.Pieces([b"a", b"b", b"ab", b" "]), np.log([0.2, 0.1, 0.1, 0.3]), math.log(0.3))
    words = [b""]
    total = 0.0
    for _ in range(9):
        total += np.exp(model.words(words)).sum()
        words = [w + c for w in words for c in (b"a", b"b")]
    assert total <= 1.0


def test_the_vocabulary_spells_every_byte():
    strings, prior = lattice.vocabulary(pieces_path())
    assert len(set(strings)) == len(strings) and {bytes([b]) for b in range(256)} <= set(strings)
    assert prior.sum() == pytest.approx(1.0) and (prior > 0).all()
    assert all(s.rfind(b" ") <= 0 for s in strings)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = [f"{a}{b}{c}" for a in ("th", "Sch", "é", "12") for b in ("er", "on", "ing") for c in ("", "ly", "東")]
    texts = [None, "", " \t\n", "One one ONE", "É é", "x y\x1cz", "tail\x0bvt\x0c", "once" * 2000, "nul\0a"]
    texts += [" ".join(rng.choices(words, k=rng.randrange(1, 80))) for _ in range(80)] + [" ".join(rng.choices(words, k=20_000))]
    return list(enumerate(texts)) + [(3, "One one ONE"), (None, "ther ther"), (None, None)]


def scored(spark, rows, train, parts=3, **more):
    df = spark.createDataFrame([(i, t, i is None, "w", 1, 2, "x") for i, t in rows], SCHEMA).repartition(parts)
    return lattice.score_texts(df, pieces_path(), train, **more).collect()


def learned(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 != 1


def is_learned():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 1


def test_counts_and_base_equal_brute_force(spark, rows):
    tokens = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [None]) for i, t in rows]
    counts = Counter(w for i, t in tokens if learned(i) for w in t)
    n, v = sum(counts.values()), len(counts)
    wanted = sorted((i is None, i or 0, len(t), sum(counts[w] > 0 for w in t), n,
                     round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6)) for i, t in tokens)
    got = scored(spark, rows, is_learned())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == wanted
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    one = {r.doc_id: r.score for r in got}
    assert one[0] == one[1] == one[2]  # an end alone


def test_blocks_do_not_change_scores(spark, rows):
    batch = pa.record_batch([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows]),
                             pa.array([learned(i) for i, _ in rows])], ["id", "text", "train"])
    whole = pa.Table.from_batches(list(lattice._indexer(iter([batch])))).to_pandas()
    limit, lattice.BLOCK_ROWS = lattice.BLOCK_ROWS, 100
    try:
        cut = pa.Table.from_batches(list(lattice._indexer(iter([batch.slice(i, 4) for i in range(0, len(rows), 4)])))).to_pandas()
    finally:
        lattice.BLOCK_ROWS = limit
    assert cut.block.nunique() > 5 and whole.block.nunique() == 1
    sums = [t[t.word.notna()].groupby("word").n_train.sum().to_dict() for t in (whole, cut)]
    assert sums[0] == sums[1]
    assert sorted(x.score for x in scored(spark, rows, is_learned(), 1)) == pytest.approx(
        sorted(x.score for x in scored(spark, rows, is_learned(), 7)), rel=1e-9)


def test_learning_helps_and_rare_words_keep_a_share(spark, rows):
    new = [(1000 + i, "therly Schoning ther " * 5) for i in range(3)]
    none = {r.doc_id: r.score for r in scored(spark, rows + new, F.lit(False))}
    some = {r.doc_id: r.score for r in scored(spark, rows + new, F.col("doc_id") < 1000)}
    assert all(some[1000 + i] > none[1000 + i] for i in range(3))
    assert scored(spark, [(1, "a b")], F.lit(None).cast("boolean"))[0].train_tokens == 0


def test_nothing_to_score(spark):
    assert scored(spark, [], is_learned(), 1) == []
    got = scored(spark, [(1, None)], F.lit(True))[0]
    assert (got.n_tokens, got.n_known, got.train_tokens) == (1, 1, 1) and got.base_score == pytest.approx(math.log10(1.5 / 2))
