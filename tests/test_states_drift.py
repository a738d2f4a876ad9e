"""Mergeable check states, schema drift, change levels, the deduplicating ingest and the state history."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from chronoset.operators import changes, drift, quality, scd2
from chronoset.operators.check_states import CheckStates
from chronoset.operators.shape import latest_per_day
from chronoset.streaming import ingest
from chronoset.streaming.open_state import OpenState

D = dt.date(2025, 1, 1)
NESTED = "event_id long, ts timestamp_ntz, value double, profile struct<user_id: long, event_type: string, props: string>"


def put(root, name, lines):
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, name), "w") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def event(i, day, key, kind="a", hour=10):
    return {"event_id": i, "ts": f"2025-01-{day:02d}T{hour:02d}:00:00.000000", "value": 1.0, "profile": {"user_id": key, "event_type": kind, "props": "p"}}


# --- states --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def checked(spark):
    rnd = random.Random(1)
    rows = [(f"f{d}", D + dt.timedelta(d), rnd.randrange(5000), None if rnd.random() < 0.1 * d else rnd.gauss(0, 1)) for d in range(5) for _ in range(2000)]
    return spark.createDataFrame(rows, "file_name string, file_date date, k long, v double")


def test_merged_states_say_what_a_pass_over_the_rows_says(spark, tmp_path, checked):
    states = CheckStates(spark, str(tmp_path / "s"), ["k", "v"], distinct=["k"], ranged=["v"])
    states.add(checked.where("file_name <> 'f3'"))
    states.add(checked.where("file_name = 'f3' and v is null"))  # a short first delivery
    states.add(checked.where("file_name = 'f3'"))
    rules = [quality.has_size(), quality.is_complete("k"), quality.is_complete("v")]
    for first, last in ((None, None), (D + dt.timedelta(1), D + dt.timedelta(3)), (D + dt.timedelta(9), None)):
        inside = checked.where(F.col("file_date").between(F.lit(first or D), F.lit(last or dt.date(2030, 1, 1))))
        assert states.run_checks(rules, first, last).collect() == quality.run_checks(inside, rules).collect()
    p = {r["column"]: r for r in states.profile(quantiles=(0.5, 0.9)).collect()}
    want = checked.agg(F.count_distinct("k"), F.min("v"), F.max("v"), F.percentile("v", 0.5), F.percentile("v", 0.9)).first()
    assert abs(p["k"]["n_distinct"] - want[0]) < 0.05 * want[0]
    assert (p["v"]["lo"], p["v"]["hi"]) == (want[1], want[2])
    for q, v in (("q0.5", want[3]), ("q0.9", want[4])):
        below = checked.where(F.col("v") <= p["v"][q]).count() / checked.where("v is not null").count()
        assert abs(below - float(q[1:])) < 0.03, v
    with pytest.raises(ValueError, match="no states"):
        states.run_checks([quality.is_complete("other")])


def test_states_are_small_and_files_are_not_read_again(spark, tmp_path, checked):
    states = CheckStates(spark, str(tmp_path / "s"), ["k"])
    checked.write.partitionBy("file_date").parquet(str(tmp_path / "t"))
    states.add(spark.read.parquet(str(tmp_path / "t")))
    assert states.files().count() == 5
    plan = states.run_checks([quality.has_size()])._jdf.queryExecution().toString()
    assert str(tmp_path / "t") not in plan


# --- drift ---------------------------------------------------------------------------

def test_drift_names_unknown_absent_and_retyped_fields(spark):
    good = {"id": 1, "amount": "5", "who": {"k": "a", "tier": "gold"}}
    lines = {
        "as_declared": [good, {**good, "amount": None}, {**good, "amount": 5}],
        "new": [{**good, "x": 1}, {**good, "x": "t"}, {**good, "who": {**good["who"], "y": {"z": 1}}}],
        "gone": [{"id": 1, "amount": "5"}],
        "partly": [good, {"id": 2, "who": {"k": "b"}}],
        "typed": [{"id": "1", "amount": True, "who": {"k": 5, "tier": "x"}}, good],
        "other": [{**good, "who": ["a"]}],
        "broken": ['{"id": 1', "[1, 2]", "", good],
    }
    df = spark.createDataFrame([(f, x if isinstance(x, str) else json.dumps(x)) for f, xs in lines.items() for x in xs], "f string, value string")
    got = {tuple(r) for r in drift.drift(spark, df, "id long, amount string, who struct<k: string, tier: string>", ["f"], accept={"amount": {"BIGINT"}}).collect()}
    assert got == {
        ("new", "x", "unknown", "BIGINT,STRING", 2), ("new", "who.y", "unknown", "OBJECT", 1),
        ("gone", "who", "absent", "", 0),
        ("typed", "id", "retyped", "STRING", 1), ("typed", "amount", "retyped", "BOOLEAN", 1), ("typed", "who.k", "retyped", "BIGINT", 1),
        ("other", "who", "retyped", "ARRAY", 1), ("other", "who.k", "absent", "", 0), ("other", "who.tier", "absent", "", 0),
        ("broken", "", "broken", "BROKEN", 3)}
    assert drift.drift(spark, df.limit(0), "id long", ["f"]).count() == 0


# --- levels ---------------------------------------------------------------------------

def test_change_levels_and_violations(spark):
    order = ["state", "city", "zip"]
    rows = [(1, 1, "A", "x", "1", "g"), (1, 2, "B", "y", "2", "g"), (1, 3, "C", "y", "3", "g"), (1, 4, "C", "z", "3", "s"), (1, 5, "C", "z", "3", "t"),
            (1, 6, None, "w", "4", "t"), (1, 7, None, "w", None, "t"), (2, 1, None, None, None, None)]
    df = spark.createDataFrame(rows, "k int, start int, state string, city string, zip string, tier string")
    got = [tuple(r)[1:] for r in changes.change_levels(df, "k", order, ["tier"], "start").orderBy("start").collect()]
    assert got == [(2, "state", "", ""), (3, "state", "city", ""), (4, "city", "zip", "tier"), (5, None, "", "tier"), (6, "state", "", ""), (7, "zip", "", "")]


# --- once ------------------------------------------------------------------------------

def test_rows_delivered_twice_are_taken_once_across_runs(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    take = lambda: ingest.ingest_files(spark, src, NESTED, out, ck, once=("event_id", "ts", "30 days"))
    put(src, "a.json", [event(1, 1, 1), event(2, 1, 1), event(1, 1, 1), '{"event_id": 9, "ts"', {**event(5, 1, 1), "event_id": None}])
    assert sorted(r["event_id"] for r in take().collect()) == [1, 2]
    put(src, "b.json", [event(2, 1, 1), event(3, 2, 1), event(4, 1, 2)])
    assert sorted(r["event_id"] for r in take().collect()) == [1, 2, 3, 4]
    bad = ingest.broken_lines(spark, out).collect()
    assert sorted(r["reason"] for r in bad) == ["broken line", "missing id or timestamp"] and all(r["line"] for r in bad)


# --- state -----------------------------------------------------------------------------

def test_state_history_equals_a_build_at_every_step(spark, tmp_path):
    rnd = random.Random(7)
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    state = OpenState("user_id", ["event_type", "props"], ["event_type"], ["ts", "event_id"])
    rows = []
    # a day in two deliveries, a NULL attribute, then a late row of one key, then rows of that key again
    for n, days in enumerate([(1, 2), (2, 3, 4), (5,), (2,), (6,)]):
        keys = [2] if n == 3 else [1, 2, 3]
        batch = [event(100 * n + i, rnd.choice(days), rnd.choice(keys), rnd.choice(["a", "b", None]), rnd.randrange(24)) for i in range(14)]
        rows += batch
        put(src, f"{n}.json", batch)
        state.drain(spark, src, NESTED, "profile", out, ck)
        state.drain(spark, src, NESTED, "profile", out, ck)  # nothing pending
        flat = [(r["event_id"], dt.datetime.fromisoformat(r["ts"]), r["profile"]["user_id"], r["profile"]["event_type"], "p") for r in rows]
        df = spark.createDataFrame(flat, "event_id long, ts timestamp_ntz, user_id long, event_type string, props string")
        want = scd2.build(latest_per_day(df, "user_id", F.to_date("ts"), ["ts", "event_id"], ["event_type", "props"]), "user_id", "day", ["event_type"], ["event_type", "props"])
        cols = ["user_id", "event_type", "props", *scd2.BOOK_COLS]
        got = state.history(spark, out, df)
        assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect())), n
    kinds = {r["_kind"] for r in spark.read.parquet(out).select("_kind").distinct().collect()}
    assert kinds == {"closed", "tail", "late"}
