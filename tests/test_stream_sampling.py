"""Streaming history vs batch build, sampling paths, and the driver contract."""

import datetime as dt
import json
import os
import random

import pytest

from pyspark.sql import functions as F

from chronoset.operators import sampling, scd2
from chronoset.operators.shape import latest_per_day
from chronoset.plans.catalog import E_NESTED_SCHEMA
from chronoset.session import scratch_path
from chronoset.streaming import history, ingest

SF001 = "/root/testdata/sf0.001"


def _write_day_files(root, rows_by_day, order):
    """One file per day, modification times in `order` (arrival order)."""
    t0 = 1_700_000_000
    for i, day in enumerate(order):
        d = os.path.join(root, f"file_date={day}")
        os.makedirs(d, exist_ok=True)
        p = os.path.join(d, f"transactions_{day}.json")
        with open(p, "w") as f:
            for r in rows_by_day[day]:
                f.write(json.dumps(r) + "\n")
        os.utime(p, (t0 + i, t0 + i))


def _fixture(seed=3):
    rnd = random.Random(seed)
    rows_by_day, eid = {}, 0
    for day in range(1, 9):
        date = dt.date(2025, 1, day)
        rows = []
        for _ in range(12):
            eid += 1
            ts = dt.datetime(2025, 1, day, rnd.randint(0, 23), rnd.randint(0, 59), rnd.randint(0, 59), eid)
            rows.append({"event_id": eid, "ts": ts.strftime("%Y-%m-%dT%H:%M:%S.%f"), "value": 1.0,
                         "profile": {"user_id": rnd.randint(1, 4), "event_type": rnd.choice(["a", "b", "c"]),
                                     "props": rnd.choice(["x", "y"])}})
        rows_by_day[str(date)] = rows
    return rows_by_day


def _batch_build(spark, rows_by_day):
    flat = [(r["event_id"], dt.datetime.strptime(r["ts"], "%Y-%m-%dT%H:%M:%S.%f"), r["profile"]["user_id"],
             r["profile"]["event_type"], r["profile"]["props"]) for rs in rows_by_day.values() for r in rs]
    df = spark.createDataFrame(flat, "event_id long, ts timestamp_ntz, user_id long, event_type string, props string")
    daily = latest_per_day(df, "user_id", F.to_date("ts"), ["ts", "event_id"], ["event_type", "props"])
    return scd2.build(daily, "user_id", "day", ["event_type"], ["event_type", "props"])


def _rows(df):
    return sorted(tuple(r) for r in df.select("user_id", "event_type", "props", *scd2.BOOK_COLS).collect())


def test_stream_history_equals_batch_out_of_order(spark, tmp_path):
    rows_by_day = _fixture()
    days = sorted(rows_by_day)
    order = days[1::2] + days[0::2]  # odd days first, then even days
    src = str(tmp_path / "src")
    _write_day_files(src, rows_by_day, order)
    store = history.run_history_stream(spark, src, E_NESTED_SCHEMA, str(tmp_path / "dim"),
                                       str(tmp_path / "ckpt"), max_files_per_trigger=1)
    assert store.version() == len(days)
    assert _rows(store.read()) == _rows(_batch_build(spark, rows_by_day))


def test_stream_history_in_order_uses_delta_commits(spark, tmp_path):
    rows_by_day = _fixture(5)
    days = sorted(rows_by_day)
    src = str(tmp_path / "src")
    _write_day_files(src, rows_by_day, days)
    store = history.run_history_stream(spark, src, E_NESTED_SCHEMA, str(tmp_path / "dim"),
                                       str(tmp_path / "ckpt"), max_files_per_trigger=2)
    st = store.state()
    # days arrive in order: every version adds the rows it closed to those before it
    n = len(days) // 2
    assert st["version"] == n and st["max_day"] == dt.date(2025, 1, 8) and st["closed"] == list(range(1, n + 1))
    assert _rows(store.read()) == _rows(_batch_build(spark, rows_by_day))
    # the version before is the build of the days folded until then
    part = {d: rows_by_day[d] for d in days[:6]}
    assert _rows(store.read(n - 1)) == _rows(_batch_build(spark, part))


@pytest.mark.parametrize("order", ["in_order", "odd_even"])
def test_stream_history_with_snapshot_compaction(spark, tmp_path, order):
    rows_by_day = _fixture(6)
    days = sorted(rows_by_day)
    arrival = days if order == "in_order" else days[1::2] + days[0::2]
    src = str(tmp_path / "src")
    _write_day_files(src, rows_by_day, arrival)
    store = history.run_history_stream(spark, src, E_NESTED_SCHEMA, str(tmp_path / "dim"), str(tmp_path / "ckpt"),
                                       max_files_per_trigger=1, compact_every=3)
    assert _rows(store.read()) == _rows(_batch_build(spark, rows_by_day))
    # more than three parts become one
    left = sorted(os.listdir(tmp_path / "dim" / "snapshots"))
    assert left == sorted(store.state()["snapshots"]) and len(left) <= 3 and any(n.startswith("part=to-") for n in left)


def test_stream_restart_does_not_reprocess(spark, tmp_path):
    rows_by_day = _fixture(4)
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ck")
    _write_day_files(src, rows_by_day, sorted(rows_by_day))
    first = ingest.ingest_files(spark, src, E_NESTED_SCHEMA, out, ck).count()
    again = ingest.ingest_files(spark, src, E_NESTED_SCHEMA, out, ck).count()
    assert first == again == sum(len(v) for v in rows_by_day.values())


def test_distributed_top_n_equals_local(spark):
    df = spark.range(0, 2000).withColumn("k", F.col("id") * 7 % 2003)
    order = [F.md5(F.concat(F.lit("s"), F.col("k").cast("string"))), F.col("k")]
    local = sorted(r["k"] for r in df.orderBy(*order).limit(333).collect())
    dist = sorted(r["k"] for r in sampling.top_n(df, order, 333, cell_rows=7).collect())
    assert local == dist and len(dist) == 333


def test_one_per_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "d"), (2, "e")], "k int, v string")
    a = sorted(tuple(r) for r in sampling.one_per_key(df, "k", "s1").collect())
    b = sorted(tuple(r) for r in sampling.one_per_key(df.repartition(3), "k", "s1").collect())
    assert a == b and len(a) == 2


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["user_id", "event_type", "props", "effective_start_date", "effective_end_date", "is_current"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_scratch_is_under_checkpoint_dir(spark):
    p = scratch_path(spark, "x")
    assert p.startswith(spark.sparkContext.getCheckpointDir())


def test_smoke_queries_run(spark):
    import __spark_entry__ as entry

    for name in ["latest_profile_per_day", "scd2_append_all", "asof_lookup", "dq_checks", "file_dates"]:
        df = entry.queries()[name](spark, SF001)
        assert not df.isEmpty() and len(set(df.columns)) == len(df.columns)


def test_run_stream_and_run_batch_agree(spark, tmp_path):
    from chronoset import jobs
    from chronoset.sources import files

    rows_by_day = _fixture(7)
    src = str(tmp_path / "src")
    _write_day_files(src, rows_by_day, sorted(rows_by_day, reverse=True))
    cfg = jobs.FeedConfig(schema=E_NESTED_SCHEMA, key="user_id", struct_name="profile", ts_col="ts",
                          id_col="event_id", attrs=["event_type", "props"], tracked=["event_type"],
                          fact_cols=["event_id", "ts", "value"])
    jobs.run_stream(spark, src, cfg, str(tmp_path / "s"), str(tmp_path / "ck"), max_files_per_trigger=3)
    manifest = files.manifest(spark, src)
    first = jobs.run_batch(spark, manifest, cfg, str(tmp_path / "b"), batch_id=1)
    again = jobs.run_batch(spark, manifest, cfg, str(tmp_path / "b"), batch_id=2)
    assert first["status"] == "done" and again["status"] == "nothing_pending"
    expected = _rows(_batch_build(spark, rows_by_day))
    assert _rows(jobs.read_dimension(spark, str(tmp_path / "s"))) == expected
    assert _rows(jobs.read_dimension(spark, str(tmp_path / "b"))) == expected
    total = sum(len(v) for v in rows_by_day.values())
    assert jobs.read_facts(spark, str(tmp_path / "s")).count() == total
    assert jobs.read_facts(spark, str(tmp_path / "b")).count() == total


@pytest.mark.parametrize("cell_rows", [1, 10**6])
@pytest.mark.parametrize("n", [0, 1, 286, 1999, 2000, 2500])
def test_distributed_top_n_exact_at_cell_edges(spark, n, cell_rows):
    df = spark.range(0, 2000).withColumn("k", F.col("id") * 7 % 2003)
    order = [F.md5(F.concat(F.lit("t"), F.col("k").cast("string"))), F.col("k")]
    want = sorted(r["k"] for r in df.orderBy(*order).limit(n).collect())
    got = sorted(r["k"] for r in sampling.top_n(df, order, n, cell_rows=cell_rows).collect())
    assert got == want


def test_top_n_of_equal_hashes_and_null_keys(spark):
    rows = [(None, 1), (None, 2), ("", 3), ("a", 4), ("a", 5), (None, 6)]
    df = spark.createDataFrame(rows, "k string, i int")
    # NULL and empty text hash alike, so their rows fill one cell that no digit divides
    order = [sampling.hash_order("s", "k"), F.col("k"), F.col("i")]
    want = [r["i"] for r in df.orderBy(*order).collect()]
    for n in range(len(rows) + 2):
        assert sorted(r["i"] for r in sampling.top_n(df, order, n, cell_rows=1).collect()) == sorted(want[:n])
    assert sampling.sample_rows(df.limit(0), ["k"], 0.5, "s").count() == 0


def test_key_sample_keeps_whole_keys_and_reaches_the_scan(spark):
    path = f"{SF001}/events.parquet"
    ev = spark.read.parquet(path)
    sampled = sampling.key_sample(ev, "user_id", 0.4, "s")
    keys = [r[0] for r in ev.select("user_id").distinct().orderBy(F.md5(F.concat(F.lit("s"), F.col("user_id").cast("string"))), "user_id").collect()]
    daily = latest_per_day(ev, "user_id", F.to_date("ts"), ["ts", "event_id"], ["event_type"])
    out = scd2.build(daily, "user_id", "day", ["event_type"]).where(sampled)
    assert {r[0] for r in out.select("user_id").distinct().collect()} == set(keys[: round(0.4 * len(keys))])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Aggregate") < plan.index("md5(")
