import os
import tempfile

from pyspark.sql import functions as F

from bandwise.functions.columns import forward, split_label
from bandwise.operators.calibration import fit_conformal, fit_temperature
from bandwise.operators.gaussian import fit_group_gaussian
from bandwise.plans.calibration import conformal_test
from bandwise.sources.fixtures import events_frame
from bandwise.streaming import coverage_monitor, score_stream
from tests.conftest import SMOKE


def test_stream_scores_equal_batch_scores(spark):
    frame = events_frame(spark, SMOKE)
    model = fit_group_gaussian(frame, by=["segment"])
    pred = model.transform(frame)
    temp = fit_temperature(pred)
    pred = temp.transform(pred).withColumn("sigma", F.exp(0.5 * F.col("log_var_cal")))
    conf = fit_conformal(pred)

    schema = spark.read.parquet(os.path.join(SMOKE, "events.parquet")).schema
    raw = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
           .parquet(SMOKE))
    stream = raw.select(F.col("event_id").alias("key"), F.col("event_type").alias("segment"),
                        "ts", forward("value", "log1p").alias("y"),
                        split_label("event_id").alias("split"))
    scored = score_stream(stream, model, temp, conf, transform="log1p")
    ckpt = tempfile.mkdtemp(prefix="bw-stream-")
    q = (scored.select("key", "cp_lower", "cp_upper").writeStream.format("memory")
         .queryName("bw_scored").option("checkpointLocation", ckpt).outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("bw_scored").where("key % 7 = 0").toPandas().set_index("key").sort_index()
    batch, _, _ = conformal_test(spark, SMOKE)
    want = batch.select("key", "cp_lower", "cp_upper").toPandas().set_index("key")
    common = got.index.intersection(want.index)
    assert len(common) > 0
    assert (abs(got.loc[common] - want.loc[common]) < 1e-9).all().all()

    mon = coverage_monitor(scored, "ts", "1 day", "1 day")
    ck2 = tempfile.mkdtemp(prefix="bw-mon-")
    q2 = (mon.writeStream.format("memory").queryName("bw_cov").option("checkpointLocation", ck2)
          .outputMode("update").start())
    q2.processAllAvailable()
    q2.stop()
    cov = spark.table("bw_cov").toPandas()
    assert len(cov) > 0 and cov.coverage.between(0, 1).all()


def test_coverage_monitor_equals_batch_windows(spark):
    frame = events_frame(spark, SMOKE)
    model = fit_group_gaussian(frame, by=["segment"])
    pred = model.transform(frame)
    temp = fit_temperature(pred)
    pred = temp.transform(pred).withColumn("sigma", F.exp(0.5 * F.col("log_var_cal")))
    conf = fit_conformal(pred)

    schema = spark.read.parquet(os.path.join(SMOKE, "events.parquet")).schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SMOKE)
    stream = raw.select(F.col("event_id").alias("key"), F.col("event_type").alias("segment"), "ts",
                        forward("value", "log1p").alias("y"), split_label("event_id").alias("split"))
    mon = coverage_monitor(score_stream(stream, model, temp, conf, transform="log1p"), "ts", "1 day", "1 day")
    q = (mon.writeStream.format("memory").queryName("bw_cov_eq")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="bw-mon2-")).outputMode("update").start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("bw_cov_eq").withColumn("window", F.col("window.start").cast("string")).toPandas()
    got = got.sort_values("n").groupby("window", as_index=False).last()   # latest update per window

    batch = spark.read.parquet(os.path.join(SMOKE, "events.parquet")).select(
        F.col("event_id").alias("key"), F.col("event_type").alias("segment"), "ts",
        forward("value", "log1p").alias("y"), split_label("event_id").alias("split"))
    want = (coverage_monitor(score_stream(batch, model, temp, conf, transform="log1p"),
                             "ts", "1 day", "1 day")
            .withColumn("window", F.col("window.start").cast("string")).toPandas())
    m = got.merge(want, on="window", suffixes=("_s", "_b"))
    assert len(m) == len(want) > 0
    assert (m.n_s == m.n_b).all() and (abs(m.coverage_s - m.coverage_b) < 1e-12).all()


def test_score_stream_without_truth(spark):
    frame = events_frame(spark, SMOKE)
    model = fit_group_gaussian(frame, by=["segment"])
    pred = model.transform(frame)
    temp = fit_temperature(pred)
    pred = temp.transform(pred).withColumn("sigma", F.exp(0.5 * F.col("log_var_cal")))
    conf = fit_conformal(pred)
    new_rows = frame.select("key", "segment").limit(5)
    out = score_stream(new_rows, model, temp, conf, transform="log1p")
    assert "y_real" not in out.columns
    rows = out.collect()
    assert len(rows) == 5 and all(r.cp_lower < r.cp_upper for r in rows)
