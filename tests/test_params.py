import os

import pytest
from pyspark.sql import functions as F

from bandwise.functions.columns import forward, split_label
from bandwise.operators.calibration import fit_conformal, fit_temperature
from bandwise.operators.gaussian import fit_group_gaussian
from bandwise.operators.params import attach, frozen
from bandwise.session import spread
from bandwise.sources.fixtures import events_frame
from bandwise.streaming import score_stream
from tests.conftest import SMOKE


@pytest.mark.parametrize("limit", [10, 100_000])
def test_parameters_stay_fixed_at_any_size(spark, tmp_path, limit):
    src = str(tmp_path / "src")
    spark.range(50).withColumn("v", F.col("id") * 2).write.parquet(src)
    kept = frozen(spark.read.parquet(src), limit=limit)
    spark.range(50).withColumn("v", F.col("id") * 3).write.mode("overwrite").parquet(src)
    assert {r.id: r.v for r in kept.collect()} == {i: 2 * i for i in range(50)}


def test_segment_parameters_are_broadcast(spark):
    rows = spark.range(100).withColumn("g", F.col("id") % 3)
    out = attach(rows, spark.createDataFrame([(i, float(i)) for i in range(3)], "g long, p double"), ["g"])
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_attach_global_needs_one_row(spark):
    rows = spark.range(3)
    with pytest.raises(ValueError):
        attach(rows, spark.range(2).withColumnRenamed("id", "p"))
    out = attach(rows, spark.createDataFrame([(1.5,)], "p double"))
    assert [r.p for r in out.collect()] == [1.5, 1.5, 1.5]


def test_spread_is_noop_on_many_partitions(spark):
    many = spark.range(100).repartition(spark.sparkContext.defaultParallelism * 2)
    assert spread(many) is many
    one = spark.range(100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_stream_with_per_segment_conformal(spark):
    import tempfile
    frame = events_frame(spark, SMOKE)
    model = fit_group_gaussian(frame, by=["segment"])
    pred = model.transform(frame)
    temp = fit_temperature(pred, by=["segment"])
    pred = temp.transform(pred).withColumn("sigma", F.exp(0.5 * F.col("log_var_cal")))
    conf = fit_conformal(pred, by=["segment"])
    schema = spark.read.parquet(os.path.join(SMOKE, "events.parquet")).schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SMOKE)
    stream = raw.select(F.col("event_id").alias("key"), F.col("event_type").alias("segment"),
                        forward("value", "log1p").alias("y"), split_label("event_id").alias("split"))
    scored = score_stream(stream, model, temp, conf, transform="log1p")
    q = (scored.select("key", "cp_lower", "cp_upper").writeStream.format("memory")
         .queryName("bw_seg_scored").option("checkpointLocation", tempfile.mkdtemp(prefix="bw-s-"))
         .start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("bw_seg_scored").toPandas().set_index("key").sort_index()
    want = (conf.transform(pred, transform="log1p").select("key", "cp_lower", "cp_upper")
            .toPandas().set_index("key").sort_index())
    assert len(got) == len(want)
    assert (abs(got - want.loc[got.index]) < 1e-9).all().all()
