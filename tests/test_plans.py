"""Plan properties of the registered queries (what `.explain()` was checked for)."""

import re

import pytest

SF001 = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange (\w+)\(([^)]*)\)", plan)


@pytest.fixture(scope="module")
def q():
    import __spark_entry__ as entry

    return entry.queries()


def test_build_two_exchanges_partial_aggregate_pruned_scan(spark, q):
    plan = _plan(q["scd2_build"](spark, SF001))
    ex = _exchanges(plan)
    # (key, day) for the daily reduction, then key for the shared lag/lead window
    assert [e[0] for e in ex] == ["hashpartitioning", "hashpartitioning"]
    assert "partial_max" in plan
    scan = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert "value" not in scan and "user_id" in scan


def test_fold_is_one_plan_not_one_job_per_day(spark, q):
    plan = _plan(q["scd2_fold_days"](spark, SF001))
    # a loop over 20 days would stack 20 merges; one plan needs the days' reduction and one exchange on the key
    assert [e[0] for e in _exchanges(plan) if e[0] != "HashedRelationBroadcastMode"] == ["hashpartitioning"] * 2


def test_merge_day_pushes_the_day_filter_to_the_scan(spark, q):
    plan = _plan(q["scd2_merge_day"](spark, SF001))
    assert re.search(r"DataFilters: \[[^\]]*ts#\d+ >= ", plan)
    assert "FullOuter" in plan


def test_samples_are_filters_of_their_input(spark, q):
    # as many exchanges as the history itself, and no window, sort or join of the sample
    plain = lambda name: re.sub(r"#\d+", "", str(_exchanges(_plan(q[name](spark, SF001)))))
    assert plain("sample_current") == plain("scd2_build")
    for name in ("sample_files", "sample_profiles"):
        plan = _plan(q[name](spark, SF001))
        assert "TakeOrderedAndProject" not in plan and "Window" not in plan and "Join" not in plan


@pytest.mark.parametrize("name", ["scd2_expire", "scd2_merge_day"])
def test_merge_reads_open_rows_once_and_joins_once(spark, q, name):
    plan = _plan(q[name](spark, SF001))
    assert len(re.findall(r"Scan parquet .*is_current=true|\(\d+\) Scan|FileScan parquet", plan)) <= 3
    assert len(re.findall(r"(?:SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", plan)) == 1
    # the day's reduction and its dealing to the buckets; the open rows stay where they are
    assert [e[0] for e in _exchanges(plan) if e[0] != "HashedRelationBroadcastMode"] == ["hashpartitioning"] * 2


def test_current_rows_read_one_folder(spark, q):
    df = q["scd2_current"](spark, SF001)
    files = df.inputFiles()
    assert files and all("/is_current=true/" in f for f in files)


def test_quality_suite_is_one_aggregate(spark, q):
    plan = _plan(q["dq_checks"](spark, SF001))
    assert plan.count("HashAggregate") <= 2 and len(_exchanges(plan)) <= 1


def test_daily_json_hint_rebalances_on_the_date(spark):
    # the hint `writers.write_daily_json` puts on its input
    from pyspark.sql import functions as F

    day = F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 5).cast("int"))
    df = spark.range(0, 50).withColumn("file_date", day)
    plan = df.hint("rebalance", 8, "file_date")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_top_n_neither_shuffles_nor_writes_its_input(spark):
    from pyspark.sql import functions as F

    from chronoset.operators import sampling

    df = spark.range(0, 500).withColumn("k", F.col("id") * 3 % 501)
    plan = _plan(sampling.top_n(df, [F.md5(F.col("k").cast("string")), F.col("k")], 200))
    assert "Exchange" not in plan and "Join" not in plan and "Filter" in plan
