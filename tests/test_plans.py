"""The physical plans the scale design relies on."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lading.operators.fetch import build_requests, fetch_requests
from lading.operators.objects import listing, write_bytes
from lading.operators.sink import write_files
from lading.sources.files import newest, read_files, with_root


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_and_json_scans_prune_and_push(spark, workdir):
    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for ft in ("csv", "json", "avro"):
        write_files(src, f"{workdir}/{ft}", ft)
        df = (read_files(spark, f"{workdir}/{ft}", ft, schema=src.schema)
              .filter(F.col("o_totalprice") > 1000).select("o_orderkey"))
        p = plan(df)
        assert "GreaterThan(o_totalprice,1000.0)" in p, ft
        assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in p, ft


def test_fetch_is_one_round_robin_exchange(spark):
    req = build_requests(spark.range(10), "id", F.lit("file:///nothing"))
    p = plan(fetch_requests(req, parallelism=3))
    assert "RoundRobinPartitioning(3)" in p and "MapInArrow" in p
    assert p.count("Exchange") == 1


def test_newest_is_a_partial_aggregate_and_picks_join_by_hash(spark, workdir):
    write_bytes(f"{workdir}/r/a.txt", b"a")
    files = with_root(spark, listing(spark, f"{workdir}/r"), [f"{workdir}/r"])
    p = plan(newest(files, "directory"))
    assert "partial_max(" in p and "partial_max_by(" in p
    picks = newest(files).select(F.col("path").alias("pick"))
    joined = files.join(F.broadcast(picks), F.col("path") == F.col("pick"), "left_semi")
    p = plan(joined)
    assert "BroadcastHashJoin" in p and "NestedLoop" not in p and "Cartesian" not in p


def test_no_cross_or_nested_loop_join_in_registered_queries(spark):
    import importlib.util
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spec = importlib.util.spec_from_file_location("entry", os.path.join(root, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    for name in ("fetch_post", "decrypt_scan", "stage_latest"):
        p = plan(entry.queries()[name](spark, SF_SMALL))
        assert "NestedLoop" not in p and "Cartesian" not in p, name
