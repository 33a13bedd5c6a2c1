import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import final_plan, rows
from threadloom.operators import quality, runs
from threadloom.operators.merge import cache_table, merge_into, merge_keep_first, merged_parts, part_of, read_current
from threadloom.operators.sinks import SUCCESS, WITH_FAILURES, append_checked, read_checked, write_clustered, write_table
from threadloom.operators.skew import hot_keys, spread_join

CACHE = "id string, v array<double>, m string"
from threadloom.session import cut, discard, scratch


def test_append_splits_rows_and_reports(spark, tmp_path):
    path = str(tmp_path / "t")
    rules = {"positive": F.col("n") > 0}
    assert append_checked(spark.createDataFrame([(1,), (2,)], "n int"), path, rules) == SUCCESS
    assert append_checked(spark.createDataFrame([(3,), (-1,), (None,)], "n int"), path, rules) == WITH_FAILURES
    assert rows(read_checked(spark, path)) == [(1,), (2,), (3,), (None,)]
    assert rows(read_checked(spark, path, "rejected"), "n", "failed_rules") == [(-1, ["positive"])]


def test_a_day_is_one_folder_in_order(spark, tmp_path):
    df = spark.range(1000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 300).alias("at"), (F.col("id") % 7).alias("k"), "id"
    )
    write_clustered(df, str(tmp_path / "t"), "at", ["k"])
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 1000 and len(list((tmp_path / "t").glob("day=*"))) == 4
    for file in (tmp_path / "t").glob("day=*/*.parquet"):
        keys = [r["k"] for r in spark.read.parquet(str(file)).coalesce(1).collect()]
        assert keys == sorted(keys)
    plan = back.filter("day = '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_merge_never_overwrites_a_value(spark):
    target = spark.createDataFrame([("a", [1.0], None), ("b", [], "old"), ("c", None, None)], CACHE)
    source = spark.createDataFrame([("a", [9.0], "new"), ("b", [2.0], "new"), ("d", [4.0], None)], CACHE)
    assert rows(merge_keep_first(target, source, "id", ["v", "m"])) == [
        ("a", [1.0], "new"), ("b", [2.0], "old"), ("c", None, None), ("d", [4.0], None),
    ]


def test_merge_refuses_a_key_twice_in_the_source(spark):
    target = spark.createDataFrame([("a", [1.0], None)], CACHE)
    source = spark.createDataFrame([("a", [9.0], "x"), ("a", [8.0], "y")], CACHE)
    with pytest.raises(Exception, match="is not unique: a"):
        merge_keep_first(target, source, "id", ["v", "m"]).collect()


def test_merge_check_adds_no_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(1000).selectExpr("cast(id as string) id", "array(1d) v", "'x' m")
        assert final_plan(merge_keep_first(target, target, "id", ["v", "m"])).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merging_rewrites_touched_parts_only(spark, tmp_path):
    root = str(tmp_path / "cache")
    flags = {"filled": "v"}
    assert read_current(spark, root, CACHE).count() == 0
    many = spark.range(500).selectExpr("cast(id as string) id", "array(1d) v", "cast(null as string) m")
    assert merge_into(many, root, "id", ["v", "m"], CACHE, flags) == list(range(8))
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "cache").rglob("*.parquet")}
    few = spark.createDataFrame([("7", [9.0], "new"), ("x", [], "new")], CACHE)
    touched = sorted({r[0] for r in few.select(part_of("id")).collect()})
    assert merge_into(few, root, "id", ["v", "m"], CACHE, flags) == touched
    now = {r["id"]: (r["v"], r["m"], r["filled"]) for r in read_current(spark, root, f"{CACHE}, filled boolean").collect()}
    assert len(now) == 501 and now["7"] == ([1.0], "new", True) and now["x"] == (None, "new", False) and now["8"] == ([1.0], None, True)
    for part in range(8):
        files = {p.name for p in (tmp_path / "cache" / f"part={part}").glob("*.parquet")}
        assert bool(files & set(before)) == (part not in touched)
    assert merge_into(few.limit(0), root, "id", ["v", "m"], CACHE, flags) == []


def test_only_the_source_of_a_merge_is_shuffled(spark, tmp_path):
    root = str(tmp_path / "cache")
    many = spark.range(500).selectExpr("cast(id as string) id", "array(1d) v", "cast(null as string) m")
    merge_into(many, root, "id", ["v", "m"], CACHE)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = spark.createDataFrame([("7", [9.0], "new"), ("x", [], "new")], CACHE)
        plan = final_plan(merged_parts(source, cache_table(spark, root, "id", CACHE), "id", ["v", "m"], [1, 2]))
        assert plan.count("Exchange hashpartitioning(id") == 1 and "Bucketed: true" in plan and "PartitionFilters: [part" in plan
        assert "FullOuter" in plan and plan.index("Bucketed: true") < plan.index("Exchange hashpartitioning")  # the cache is the left side
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_failed_merge_changes_nothing_and_another_session_goes_on(spark, tmp_path):
    root = str(tmp_path / "cache")
    merge_into(spark.createDataFrame([("a", [1.0], None)], CACHE), root, "id", ["v", "m"], CACHE)
    twice = spark.createDataFrame([("a", [2.0], "x"), ("a", [3.0], "y"), ("b", [1.0], "z")], CACHE)
    with pytest.raises(Exception, match="is not unique"):
        merge_into(twice, root, "id", ["v", "m"], CACHE)
    assert rows(read_current(spark, root, CACHE)) == [("a", [1.0], None)]
    spark.sql(f"DROP TABLE {cache_table(spark, root, 'id', CACHE).table_name}")  # as in a session that does not know it
    merge_into(spark.createDataFrame([("a", [2.0], "x"), ("c", None, None)], CACHE), root, "id", ["v", "m"], CACHE)
    assert rows(read_current(spark, root, CACHE)) == [("a", [1.0], "x"), ("c", None, None)]


def test_run_states(spark, tmp_path):
    path = str(tmp_path / "runs")
    at = dt.datetime(2024, 1, 1)
    runs.record_run(spark, path, "r", 0, "submitted", at, num_topics=3, description="d")
    runs.record_run(spark, path, "r", 1, "model_created", at)
    runs.record_run(spark, path, "r", 2, "failed", at, error_message="boom")
    runs.record_run(spark, path, "other", 0, "submitted", at + dt.timedelta(hours=1))
    latest = runs.latest_runs(spark.read.parquet(path))
    assert rows(latest, "run_id", "status", "num_topics", "description", "error_message") == [
        ("other", "submitted", None, None, None), ("r", "failed", 3, "d", "boom"),
    ]
    with pytest.raises(ValueError, match="unknown run attributes"):
        runs.record_run(spark, path, "r", 3, "x", at, nonsense=1)


def test_watermarks(spark, tmp_path):
    path, at = str(tmp_path / "marks"), dt.datetime(2024, 1, 5)
    runs.advance_watermark(spark, path, "t", at, at)
    runs.advance_watermark(spark, path, "t", dt.datetime(2024, 1, 1), at)
    marks = spark.read.parquet(path)
    assert runs.read_watermark(marks, "t") == at and runs.read_watermark(marks, "other") == runs.EPOCH
    df = spark.createDataFrame([(at,), (at + dt.timedelta(seconds=1),)], "ts timestamp")
    assert runs.incremental(df, "ts", at).count() == 1


def test_quality(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("a", None, 2.0), ("b", 3, None)], "k string, n int, s double")
    assert rows(quality.check_unique(df, ["k"])) == [("a", 2)]
    assert rows(quality.check_not_null(df, ["k", "n"])) == [("k", 0), ("n", 1)]
    assert rows(quality.check_rules(df, {"s": F.col("s") <= 1})) == [("s", 1)]
    with pytest.raises(quality.QualityError):
        quality.require_unique(df, ["k"], "frame")


def test_hot_keys_are_few_and_heavy(spark):
    counts = spark.range(100).selectExpr("id as k", "if(id < 3, 1000L + id, 10L) as n")
    assert rows(hot_keys(counts, "k", floor=100)) == [(0, 10), (1, 11), (2, 11)]
    assert rows(hot_keys(counts, "k", floor=10_000)) == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spreading_keeps_the_result(spark, how):
    left = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 0, id % 40) as k")
    right = spark.range(30).selectExpr("id as k", "id * 10 as v")
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    spread = spread_join(left, right, "k", "id", counts, how, floor=50)
    assert rows(spread, "id", "k", "v") == rows(left.join(right, "k", how), "id", "k", "v")


def test_declared_layouts(spark, tmp_path):
    df = spark.createDataFrame([("r", dt.datetime(2024, 1, 1), "a", 0.0, 1.0)], "run_id string, created_at timestamp, unified_id string, umap_x double, umap_y double")
    path = write_table(df, str(tmp_path), "document_umap_coordinates")
    assert spark.read.parquet(path).columns[-1] == "day"


def test_intermediate_tables_belong_to_the_application(spark):
    table = cut(spark.range(3))
    assert table.cut_name.split(".")[0] == scratch(spark) and scratch(spark).endswith(spark.sparkContext.applicationId.replace("-", "_"))
    discard(table)
    assert not spark.catalog.tableExists(table.cut_name)
