import os
import tempfile

from pyspark.sql import functions as F

from bandwise.functions.constants import CLARITY_LEVELS, COLOR_LEVELS, CUT_LEVELS
from bandwise.operators.prep import feature_pipeline, ordinal_encode, positive_filter
from bandwise.sources.sinks import write_report
from bandwise.sources.tables import read_catalog, read_csv, read_csv_checked, read_table
from tests.conftest import SMOKE

SCHEMA = "c_custkey bigint, c_acctbal double"


def test_csv_with_declared_schema_roundtrip(spark):
    cust = read_table(spark, SMOKE, "customer", ["c_custkey", "c_acctbal"])
    out = os.path.join(tempfile.mkdtemp(prefix="bw-csv-"), "cust")
    write_report(cust, out, fmt="csv")
    back = read_csv(spark, out, SCHEMA)
    assert dict(back.dtypes) == {"c_custkey": "bigint", "c_acctbal": "double"}
    assert back.exceptAll(cust).count() == 0 and cust.exceptAll(back).count() == 0


def test_catalog_scan_and_filter(spark):
    read_table(spark, SMOKE, "customer").createOrReplaceTempView("bw_customer")
    pos = positive_filter(read_catalog(spark, "bw_customer"), ["c_acctbal"])
    assert pos.where(F.col("c_acctbal") <= 0).count() == 0 and pos.count() > 0


def test_report_sink_parquet_partitioned(spark):
    rep = spark.createDataFrame([("a", 0.95), ("b", 0.91)], "segment string, coverage double")
    out = os.path.join(tempfile.mkdtemp(prefix="bw-rep-"), "rep")
    write_report(rep, out, partition_by=["segment"])
    assert sorted(r.segment for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_feature_pipeline_equals_expression_encoding(spark):
    rows = [(0.3, 61.5, 55.0, "Ideal", "E", "SI2"), (0.21, 59.8, 61.0, "Premium", "E", "SI1"),
            (0.23, 56.9, 65.0, "Good", "Z", "VS1"), (0.29, 62.4, 58.0, None, "I", "VS2")]
    df = spark.createDataFrame(rows, "carat double, depth double, table double, cut string, "
                                     "color string, clarity string")
    levels = {"cut": CUT_LEVELS, "color": COLOR_LEVELS, "clarity": CLARITY_LEVELS}
    piped = feature_pipeline(levels, ["carat", "depth", "table"]).fit(df).transform(df)
    enc = ordinal_encode(df, levels)
    a = [list(r.features) for r in piped.collect()]
    b = [[r.carat, r.depth, r.table, r.cut_score, r.color_score, r.clarity_score] for r in enc.collect()]
    assert a == b
    assert [r[3:] for r in b] == [[5, 6, 2], [4, 6, 3], [2, 0, 5], [0, 2, 4]]


def test_csv_rejects_are_kept_whole(spark):
    folder = tempfile.mkdtemp(prefix="bw-csv-")
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write('key,name,x\n1,"a, ""b""",2.5\nzwei,c,3\n3,d\n4,e,1,9\n5,"",\n6,f,oops\n')
    rows, rejects = read_csv_checked(spark, folder, "key int, name string, x double")
    assert sorted((r.key, r.name, r.x) for r in rows.collect()) == [(1, 'a, "b"', 2.5), (5, None, None)]
    assert sorted(r.line for r in rejects.collect()) == ["3,d", "4,e,1,9", "6,f,oops", "zwei,c,3"]
    assert rejects.count() == 4 and rows.count() == 2 and rows.select("name").count() == 2
    assert {os.path.basename(r.file) for r in rejects.collect()} == {"a.csv"}
    clash, _ = read_csv_checked(spark, folder, "key int, _rejected_line string, x double")
    assert clash.columns == ["key", "_rejected_line", "x"] and clash.count() == 2
