"""Near-duplicate documents by bottom-k sketches of one hash function.

1. A document's set holds the 64-bit hashes of its word shingles; its sketch the k least
   of them, in order. Equal sets are one class, named by the smallest id.
2. Inverted lists. Sets whose sketches are long enough are listed under every run of
   ``run`` neighbouring retained values; smaller sets under the pairs of values of
   their prefix, which no partner at the threshold can miss. A pair at the
   threshold shares no run with a probability of about 1e-10 at the defaults.
3. Every list has a hub, its least class. (hub, member) pairs whose union sketch estimates enough
   similarity are confirmed on full sets; confirmed links give components.
4. What a hub leaves open: two members of one hub's lists that lie in different components. These are
   compared in blocks, by union sketches first and then on full sets, and only links that join
   components leave a block. So no list, however long, is expanded into pairs.

Links are all pairs of texts at the threshold up to the run probability; equal texts share a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import bit_table, in_table, text_chunks, written
from bandwise.llm.components import connected_components
from bandwise.llm.shingles import mix, shingle_set

#: Rows and shingles that one side of a block of comparisons holds about.
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 1_000_000
#: Standard deviations of the union-sketch estimate that the filter allows for.
DEVIATIONS = 6.0


def _sketcher(words: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            sets = [shingle_set(t, words) for t in chunk.column(1).to_pylist()]
            finger = [(int(mix(s).sum(dtype=np.uint64).view(np.int64)),
                       int(mix(s + np.uint64(0x1234567)).sum(dtype=np.uint64).view(np.int64))) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([f[0] for f in finger], pa.int64()), pa.array([f[1] for f in finger], pa.int64()),
                 pa.array([s[:k].tobytes() for s in sets], pa.binary())],
                ["doc_id", "n_shingles", "f1", "f2", "sketch"])
    return run


def list_keys(sketch: np.ndarray, n: int, k: int, run: int, percent: int) -> np.ndarray:
    """Keys of the inverted lists of a set with n shingles."""
    out = []
    if n >= k:
        total = np.zeros(len(sketch) - run + 1, np.uint64)
        for i in range(run):
            total = total * np.uint64(0x5851F42D4C957F2D) + sketch[i:i + len(total)]
        out.append(mix(total))
    if 1 < n <= k * 100 // percent:
        # partners share at least ceil(percent of n) values, two of them within this prefix of both
        prefix = sketch[:min(n - -(-percent * n // 100) + 2, len(sketch))]
        i, j = np.triu_indices(len(prefix), 1)
        out.append(mix(prefix[i] * np.uint64(0x9E3779B97F4A7C15) + prefix[j] + np.uint64(1)))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def _lister(k: int, run: int, percent: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                keys = [list_keys(np.frombuffer(s, "<u8"), n, k, run, percent) for n, s in zip(
                    part.column(1).to_pylist(), part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)),
                     pa.array(np.repeat(np.asarray(part.column(0)), [len(x) for x in keys]))], ["key", "rep"])
    return go


def union_estimate(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Jaccard estimate of two sketches: the share of common values among the k least of both."""
    union = np.union1d(a, b)[:k]
    return len(np.intersect1d(np.intersect1d(a, b, True), union, True)) / max(len(union), 1)


def _estimates(k: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [union_estimate(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), k) >= least
                  for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(b.columns[:2], ["hub", "rep"]).filter(pa.array(ok, pa.bool_()))
    return run


def _overlaps(rows: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Common values of every row with every other, through the values that both sides hold."""
    flat_a, flat_b = np.concatenate(rows), np.concatenate(others)
    values = np.intersect1d(flat_a, flat_b)
    out = np.zeros((len(rows), len(others)), np.float32)
    at_a = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at_b = np.repeat(np.arange(len(others)), [len(r) for r in others])
    col_a, col_b = np.searchsorted(values, flat_a), np.searchsorted(values, flat_b)
    in_a = (col_a < len(values)) & (values[np.minimum(col_a, len(values) - 1)] == flat_a) if len(values) else None
    in_b = (col_b < len(values)) & (values[np.minimum(col_b, len(values) - 1)] == flat_b) if len(values) else None
    for low in range(0, len(values), 4096):  # a bounded stretch of values at a time
        x, y = np.zeros((len(rows), 4096), np.float32), np.zeros((len(others), 4096), np.float32)
        here = in_a & (col_a >= low) & (col_a < low + 4096)
        x[at_a[here], col_a[here] - low] = 1
        here = in_b & (col_b >= low) & (col_b < low + 4096)
        y[at_b[here], col_b[here] - low] = 1
        out += x @ y.T
    return out


def _apart(t: dict, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which of the rows i and j lie in different components, were left open by the hub, and have
    sizes that a pair at the threshold can have."""
    n, comp, ball = t["n"], t["component"], t["ball"]
    a, b = n[i][:, None], n[j][None, :]
    return (comp[i][:, None] != comp[j][None, :]) & ~(ball[i][:, None] & ball[j][None, :]) \
        & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))


def _sides(t: dict) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of a block's two sides; a block compared with itself has one side twice."""
    i, j = np.flatnonzero(t["block"] == t["low"]), np.flatnonzero(t["block"] == t["high"])
    return i, j


def _columns(table: pa.Table, binary: str) -> dict:
    t = {c: np.asarray(table[c].combine_chunks() if table.num_rows else table[c]) for c in table.column_names if c != binary}
    t[binary] = [np.frombuffer(x, "<u8") for x in table[binary].to_pylist()]
    return t


def _open_rows(k: int, least: float, percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Rows of a block that have an open pair whose union sketch passes."""
        t = _columns(table, "sketch")
        i, j = _sides(t)
        wanted = np.zeros(len(t["rep"]), bool)
        if len(i) and len(j):
            apart = _apart(t, i, j, percent)
            if apart.any():
                common = _overlaps([t["sketch"][x] for x in i], [t["sketch"][x] for x in j])
                # a union sketch has at most as many common values as both sketches together
                for a, b in zip(*np.nonzero(apart & (common >= least * np.minimum(
                        k, np.maximum(t["n"][i][:, None], t["n"][j][None, :]))))):
                    wanted[i[a]] = wanted[j[b]] = True
        return pa.table({"hub": t["hub"][wanted], "rep": t["rep"][wanted]},
                        schema=pa.schema([("hub", pa.int64()), ("rep", pa.int64())]))
    return run


def _joining_links(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Links of a block that join components: a spanning set of them."""
        t = _columns(table, "shingles")
        i, j = _sides(t)
        links, parent = [], {}

        def root(c):
            while parent.setdefault(c, c) != c:
                c = parent[c]
            return c

        if len(i) and len(j):
            apart = _apart(t, i, j, percent)
            if apart.any():
                both = _overlaps([t["shingles"][x] for x in i], [t["shingles"][x] for x in j]).astype(np.int64)
                union = t["n"][i][:, None] + t["n"][j][None, :] - both
                for a, b in zip(*np.nonzero(apart & (100 * both >= percent * union))):
                    x, y = root(t["component"][i[a]]), root(t["component"][j[b]])
                    if x != y:
                        parent[max(x, y)] = min(x, y)
                        links.append((t["rep"][i[a]], t["rep"][j[b]]))
        return pa.table([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())],
                        names=["a", "b"])
    return run


def _hub_links(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Links of a hub with the members in one block of its list."""
        hub, reps = table["hub"][0].as_py(), table["rep"].to_pylist()
        sets = [np.frombuffer(x, "<u8") for x in table["shingles"].to_pylist()]
        found = []
        for centre in (s for rep, s in zip(reps, sets) if rep == hub):
            for rep, s in zip(reps, sets):
                if rep != hub:
                    both = len(np.intersect1d(centre, s, True))
                    if 100 * both >= percent * (len(centre) + len(s) - both):
                        found.append(rep)
        found = sorted(set(found))
        return pa.table([pa.array([hub] * len(found), pa.int64()), pa.array(found, pa.int64())], names=["a", "b"])
    return run


def _sets(words: int, wanted):
    """Full sets of the rows (doc_id, text, hash of the id) whose hash has its bit set in the broadcast table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(in_table(wanted.value, np.asarray(batch.column(2)))))
            for chunk in text_chunks(iter([some])):
                sets = [shingle_set(t, words) for t in chunk.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [chunk.column(0), pa.array([int(s.sum(dtype=np.uint64).view(np.int64)) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], ["rep", "total", "shingles"])
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80, k: int = 64, run: int = 3) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id of every row.

    Texts are linked at a Jaccard similarity of ``percent`` / 100 of their sets of ``words``-word
    shingles (whole numbers, no rounding); ``component_id`` is the smallest id reachable, and that row is
    kept. Texts without words link with nothing. Rows with equal sets share ``class_id``, the
    smallest id among them. An id that rows with several texts share is linked by any of them. A row with a null id names no class: it belongs
    to that of its text, and is kept only if no named row has the same set. Rows repeated
    with one id are linked like others and all kept or not. An empty table gives no
    rows; other columns are ignored.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, n_shingles long, f1 long, f2 long"
    base = written(slim.mapInArrow(_sketcher(words, k), schema + ", sketch binary"), "sketches")
    named = base.where("n_shingles > 0 and doc_id is not null")
    classes = written(named.groupBy("f1", "f2", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.min_by("sketch", "doc_id").alias("sketch")), "classes")
    least = percent / 100 - DEVIATIONS * (percent / 100 * (1 - percent / 100) / k) ** 0.5
    # dealt by key once, for the hubs and for their members
    listed = classes.select("rep", "n_shingles", "sketch").mapInArrow(
        _lister(k, run, percent), "key long, rep long").repartition("key")
    hubs = listed.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("m")).where("m > 1").select("key", "hub")
    members = written(listed.join(hubs, "key").select("hub", "rep").distinct(), "members")
    # links with the hubs
    hub_sketch = classes.select(F.col("rep").alias("hub"), F.col("sketch").alias("s1"))
    pairs = members.where("hub != rep").join(classes.select("rep", F.col("sketch").alias("s2")), "rep").join(
        hub_sketch, "hub").select("hub", "rep", "s1", "s2")
    pairs = written(pairs.mapInArrow(_estimates(k, least), "hub long, rep long"), "hub-pairs")

    def with_sets(rows: DataFrame) -> DataFrame:
        """Rows with the full set of their class, computed from its text again. A table of bits keeps
        nearly all other texts out, so no text is shuffled."""
        wanted = slim.sparkSession.sparkContext.broadcast(bit_table(rows.select(F.xxhash64("rep").alias("hash")), "hash"))
        sets = slim.where("doc_id is not null").withColumn("hash", F.xxhash64("doc_id")).mapInArrow(
            _sets(words, wanted), "rep long, total long, shingles binary")
        return rows.join(sets.repartition("rep").dropDuplicates(["rep", "total"]).drop("total"), "rep")

    def blocked(rows: DataFrame) -> DataFrame:
        """Each hub's rows (hub, rep, n) dealt to blocks of bounded size."""
        size = rows.groupBy("hub").agg(F.greatest(
            F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("long").alias("blocks"))
        return rows.join(written(size, "blocks"), "hub").withColumn(
            "block", F.pmod(F.xxhash64("rep"), F.col("blocks")))

    sizes = classes.select("rep", F.col("n_shingles").alias("n"))
    dealt = written(blocked(pairs.join(sizes, "rep")), "dealt")
    centres = dealt.select("hub", "block").distinct().select("hub", F.col("hub").alias("rep"), "block")
    near = with_sets(dealt.select("hub", "rep", "block").unionByName(centres))
    links = written(near.groupBy("hub", "block").applyInArrow(_hub_links(percent), "a long, b long"), "links")
    components = connected_components(links)
    # pairs that the hubs leave open
    ball = links.select(F.col("a").alias("hub"), F.col("b").alias("rep"), F.lit(True).alias("ball"))
    state = members.join(ball, ["hub", "rep"], "left").join(sizes, "rep").join(
        components.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "hub", "rep", "n", F.coalesce("component", "rep").alias("component"),
        (F.col("ball").isNotNull() | (F.col("hub") == F.col("rep"))).alias("ball"))
    state = written(state, "state")
    several = state.groupBy("hub").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.count(
        "*").alias("m")).where("c1 != c2 and m > 2").select("hub")

    def paired(rows: DataFrame) -> DataFrame:
        """Rows once for each pair of blocks that holds theirs and may hold an open pair."""
        rows = blocked(rows)
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        return rows.withColumn("other", other).withColumns(
            {"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "blocks")

    def grouped(rows: DataFrame):
        return rows.groupBy("hub", "low", "high")

    opened = paired(state.join(several, "hub", "left_semi")).join(classes.select("rep", "sketch"), "rep")
    open_rows = written(grouped(opened).applyInArrow(
        _open_rows(k, least, percent), "hub long, rep long").distinct(), "open")
    rest = paired(state.join(open_rows, ["hub", "rep"], "left_semi"))
    joined = written(grouped(with_sets(rest)).applyInArrow(_joining_links(percent), "a long, b long"), "links")
    components = connected_components(links.unionByName(joined))
    named_classes = classes.join(components.withColumnRenamed("node", "rep"), "rep", "left").select(
        "f1", "f2", "n_shingles", "rep", F.coalesce("component", "rep").alias("component"))
    found = base.select("doc_id", "n_shingles", "f1", "f2").join(
        written(named_classes, "class-components"), ["f1", "f2", "n_shingles"], "left")
    component = F.coalesce("component", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.col("doc_id").eqNullSafe(component).alias("kept"),
                        F.coalesce("rep", "doc_id").alias("class_id"))
