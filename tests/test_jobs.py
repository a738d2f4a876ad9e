"""The end-to-end jobs: nothing is lost or doubled, whatever is delivered, replayed or broken."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from chronoset import jobs
from chronoset.operators import quality, scd2
from chronoset.plans.catalog import E_NESTED_SCHEMA
from chronoset.schemas import CURRENT_COL, END_COL, START_COL
from chronoset.sinks import writers
from chronoset.sinks.dimension import Dimension
from chronoset.sinks.ledger import Ledger
from chronoset.sources import files
from chronoset.streaming.history import HistoryStream


def feed(**kw):
    given = dict(schema=E_NESTED_SCHEMA, key="user_id", struct_name="profile", ts_col="ts", id_col="event_id",
                 attrs=["event_type", "props"], tracked=["event_type"], fact_cols=["event_id", "ts", "value"], buckets=4)
    return jobs.FeedConfig(**{**given, **kw})


def event(i, ts, key, kind="a"):
    return json.dumps({"event_id": i, "ts": ts, "value": 1.0, "profile": {"user_id": key, "event_type": kind, "props": "p"}})


def put(root, day, lines, name=None):
    d = os.path.join(root, f"file_date={day}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name or f"transactions_{day}.json"), "w") as f:
        f.write("\n".join(lines) + "\n")


def manifest(spark, src):
    return files.manifest(spark, src)


def ids(df):
    return sorted(r["event_id"] for r in df.select("event_id").collect())


def keys(df):
    return sorted(r["user_id"] for r in df.select("user_id").distinct().collect())


def test_boundary_rows_do_not_replace_the_day_before(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "b")
    put(src, "2025-01-01", [event(i, f"2025-01-01T10:00:{i:02d}.000000", 1) for i in range(10)])
    jobs.run_batch(spark, manifest(spark, src), feed(), base, 1)
    put(src, "2025-01-02", [event(10, "2025-01-01T23:59:59.000000", 1), event(11, "2025-01-02T01:00:00.000000", 1)])
    jobs.run_batch(spark, manifest(spark, src), feed(), base, 2)
    assert ids(jobs.read_facts(spark, base)) == list(range(12))


def test_new_checkpoint_on_an_old_base_loses_and_doubles_nothing(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "b")
    put(src, "2025-01-01", [event(1, "2025-01-01T10:00:00.000000", 1)])
    jobs.run_stream(spark, src, feed(), base, str(tmp_path / "c1"))
    put(src, "2025-01-02", [event(2, "2025-01-02T10:00:00.000000", 2)])
    jobs.run_stream(spark, src, feed(), base, str(tmp_path / "c2"))
    assert ids(jobs.read_facts(spark, base)) == [1, 2] and keys(jobs.read_dimension(spark, base)) == [1, 2]
    # and a batch on the same base
    put(src, "2025-01-03", [event(3, "2025-01-03T10:00:00.000000", 3)])
    assert jobs.run_batch(spark, manifest(spark, src), feed(), base, 0)["files"] == 1
    assert ids(jobs.read_facts(spark, base)) == [1, 2, 3] and keys(jobs.read_dimension(spark, base)) == [1, 2, 3]


def test_crash_before_the_ledger_replays_the_same_files(spark, tmp_path, monkeypatch):
    src, base = str(tmp_path / "src"), str(tmp_path / "b")
    put(src, "2025-01-01", [event(1, "2025-01-01T10:00:00.000000", 1)])

    def fail(*a, **k):
        raise OSError("no ledger")

    with monkeypatch.context() as m:
        m.setattr(Ledger, "record", fail)
        with pytest.raises(OSError):
            jobs.run_batch(spark, manifest(spark, src), feed(), base, 1)
    assert jobs.read_facts(spark, base).isEmpty()  # not committed
    put(src, "2025-01-02", [event(2, "2025-01-02T10:00:00.000000", 2)])
    jobs.run_batch(spark, manifest(spark, src), feed(), base, 2)
    assert ids(jobs.read_facts(spark, base)) == [1, 2] and keys(jobs.read_dimension(spark, base)) == [1, 2]
    assert jobs.run_batch(spark, manifest(spark, src), feed(), base, 1)["status"] == "already_done"


def test_labels_in_any_order_and_late_days(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "b")
    put(src, "2025-01-02", [event(2, "2025-01-02T10:00:00.000000", 1, "b")])
    jobs.run_batch(spark, manifest(spark, src), feed(), base, 20250102)
    put(src, "2025-01-01", [event(1, "2025-01-01T10:00:00.000000", 1, "a")])
    jobs.run_batch(spark, manifest(spark, src), feed(), base, 20250101)
    put(src, "2025-01-03", [event(3, "2025-01-03T10:00:00.000000", 7)])
    jobs.run_batch(spark, manifest(spark, src), feed(), base, 20250100)
    dim = jobs.read_dimension(spark, base)
    assert dim.where("user_id = 1").count() == 2 and keys(dim) == [1, 7]


def test_history_takes_batch_ids_in_any_order(spark, tmp_path):
    hs = HistoryStream(spark, str(tmp_path / "h"), "user_id", ["t"], ["t"], ["ts"], compact_every=2, buckets=2)
    rows = [(k, dt.date(2025, 1, d), dt.datetime(2025, 1, d, 1), "AB"[d % 2]) for k in (1, 2) for d in range(1, 7)]
    df = spark.createDataFrame(rows, "user_id long, day date, ts timestamp_ntz, t string")
    for batch_id, d in ((9, 3), (8, 1), (7, 2), (100, 6), (1, 4), (2, 5)):
        hs.process(df.where(F.dayofmonth("day") == d), batch_id)
        hs.process(df.where(F.dayofmonth("day") == d), batch_id)  # replay
    want = scd2.build(df.drop("ts"), "user_id", "day", ["t"])
    cols = ["user_id", "t", START_COL, END_COL, CURRENT_COL]
    assert sorted(map(tuple, hs.dimension.read().select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_one_late_row_rebuilds_its_key_only(spark, tmp_path):
    hs = HistoryStream(spark, str(tmp_path / "h"), "user_id", ["t"], ["t"], ["ts"], buckets=4)
    rows = [(k, dt.date(2025, 1, d), dt.datetime(2025, 1, d, 1), "AB"[d % 2]) for k in range(40) for d in (2, 3)]
    schema = "user_id long, day date, ts timestamp_ntz, t string"
    hs.process(spark.createDataFrame(rows, schema), 1)
    before = {tuple(r) for r in hs.dimension.read().collect()}
    hs.process(spark.createDataFrame([(5, dt.date(2025, 1, 1), dt.datetime(2025, 1, 1, 1), "B")], schema), 2)
    after = {tuple(r) for r in hs.dimension.read().collect()}
    assert len(after) == 40 * 2 + 1 and {r[0] for r in after ^ before} == {5}
    # the version before stays readable
    assert {tuple(r) for r in hs.dimension.read(1).collect()} == before


def test_broken_lines_and_null_keys_stay_out_of_history(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "b")
    put(src, "2025-01-01", [event(1, "2025-01-01T10:00:00.000000", 1), event(2, "2025-01-01T10:00:00.000000", None), '{"event_id": 3, "ts": "2025'])
    put(src, "2025-01-02", [event(None, None, None)])
    jobs.run_stream(spark, src, feed(), base, str(tmp_path / "c"), max_files_per_trigger=1)
    assert ids(jobs.read_facts(spark, base)) == [1] and keys(jobs.read_dimension(spark, base)) == [1]
    bad = sorted((r["reason"], r["line"][:18]) for r in jobs.read_quarantine(spark, base).collect())
    assert [b[0] for b in bad] == ["broken line", "missing id", "missing key"]


@pytest.mark.parametrize("run", ["batch", "stream"])
def test_gate_raises_or_skips(spark, tmp_path, run):
    src, base = str(tmp_path / "src"), str(tmp_path / "b")
    put(src, "2025-01-01", [event(1, "2025-01-01T10:00:00.000000", None)])

    def go(on_fail):
        if run == "batch":
            return jobs.run_batch(spark, manifest(spark, src), feed(), base, 1, on_fail=on_fail)
        return jobs.run_stream(spark, src, feed(), base, str(tmp_path / on_fail), on_fail=on_fail)

    with pytest.raises(Exception, match="user_id_not_null"):
        go("raise")
    go("skip")
    facts = jobs.read_facts(spark, base)
    assert facts is None or facts.isEmpty()
    assert jobs.read_dimension(spark, base) is None
    assert Ledger(spark, jobs.Layout(base).ledger).read().isEmpty()


def test_raw_transactions_catch_up_and_archive(spark, tmp_path):
    src, base, kept = str(tmp_path / "src"), str(tmp_path / "b"), str(tmp_path / "kept")

    def txn(i, ts, amount="5.00", who="c1"):
        info = {"customer_id": who, "customer_name": "n", "customer_tier": "gold"}
        return json.dumps({"transaction_id": i, "transaction_timestamp": ts, "amount": amount, "customer_info": info})

    put(src, "2025-01-01", [txn("t1", "2025-01-01T10:00:00Z"), txn("t2", "yesterday"), txn("t3", "2025-01-01T11:00:00Z", "nan")])
    first, missing = jobs.catch_up(spark, manifest(spark, src), jobs.transaction_feed(), base, 1, dt.date(2025, 1, 1),
                                   dt.date(2025, 1, 3), on_fail="quarantine", archive_dir=kept)
    assert first["status"] == "done" and first["quarantined"] == 1
    assert sorted(r[0] for r in missing.collect()) == [dt.date(2025, 1, 2), dt.date(2025, 1, 3)]
    got = {r["transaction_id"]: (r["transaction_date"], r["amount_num"]) for r in jobs.read_facts(spark, base).collect()}
    assert got["t1"][0] == dt.date(2025, 1, 1) and float(got["t1"][1]) == 5.0 and got["t3"][1] is None and len(got) == 2
    assert dict(jobs.read_facts(spark, base).dtypes)["amount_num"] == "decimal(18,2)"
    assert os.path.exists(f"{kept}/file_date=2025-01-01/transactions_2025-01-01.json") and not os.path.exists(f"{src}/file_date=2025-01-01/transactions_2025-01-01.json")
    put(src, "2025-01-03", [txn("t4", "2025-01-03T10:00:00Z")])
    second, missing = jobs.catch_up(spark, manifest(spark, src), jobs.transaction_feed(), base, 2, dt.date(2025, 1, 1), dt.date(2025, 1, 3))
    assert second["files"] == 1 and [r[0] for r in missing.collect()] == [dt.date(2025, 1, 2)]


def test_file_date_rule(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 1), dt.date(2025, 1, 1)), (dt.date(2025, 1, 1), dt.date(2025, 1, 2))], "d date, f date")
    got = quality.run_checks(df, [quality.dated_as_file("d", "f", 0.4), quality.dated_as_file("d", "f", 0.6)]).collect()
    assert [(r["metric"], r["status"]) for r in got] == [(0.5, "Success"), (0.5, "Failure")]


def test_missing_dates_of_an_empty_ledger(spark):
    none = spark.createDataFrame([(None,)], "latest_date date")
    present = spark.createDataFrame([(dt.date(2025, 1, 2),)], "file_date date")
    got = files.missing_dates(none, present, dt.date(2025, 1, 3), first_day=dt.date(2025, 1, 1)).collect()
    assert sorted(r[0] for r in got) == [dt.date(2025, 1, 1), dt.date(2025, 1, 3)]
    with pytest.raises(Exception, match="first_day"):
        files.missing_dates(none, present, dt.date(2025, 1, 3)).collect()


def test_writes_leave_the_session_settings_alone(spark, tmp_path, monkeypatch):
    touched = []
    monkeypatch.setattr(type(spark.conf), "set", lambda self, k, v: touched.append(k))
    df = spark.range(100).withColumn("d", F.lit(dt.date(2025, 1, 1))).withColumn("is_current", F.lit(True))
    for mode in ("static", "dynamic"):
        writers.load_overwrite(df, str(tmp_path / mode), "d")
        writers.replace_by_date(df, str(tmp_path / mode), "d")
    writers.write_daily_json(df, str(tmp_path / "json"), "d")
    Dimension(spark, str(tmp_path / "dim"), "id").commit(df)
    assert touched == []
    assert len([n for n in os.listdir(tmp_path / "static" / "d=2025-01-01") if n.endswith(".parquet")]) == 1


@pytest.mark.parametrize("merge", [scd2.expire, scd2.merge_day, lambda *a: scd2.insert_versions(a[0], a[1], a[2], a[3], only_changed=True)])
def test_duplicate_stage_raises(spark, merge):
    day = dt.date(2025, 1, 1)
    open_end = dt.date(3000, 12, 31)
    target = spark.createDataFrame([("k", "A", day, open_end, True)], f"k string, t string, {START_COL} date, {END_COL} date, {CURRENT_COL} boolean")
    stage = spark.createDataFrame([("k", "B", dt.date(2025, 1, 2), open_end, True), ("k", "C", dt.date(2025, 1, 2), open_end, True)], target.schema)
    with pytest.raises(Exception, match="two staged profiles"):
        merge(target, stage, "k", ["t"]).collect()


def test_point_in_time_keeps_every_fact(spark):
    from chronoset.operators import lookup

    day, open_end = dt.date(2025, 1, 5), dt.date(3000, 12, 31)
    dim = spark.createDataFrame([("k", "A", day, open_end, True)], f"k string, t string, {START_COL} date, {END_COL} date, {CURRENT_COL} boolean")
    facts = spark.createDataFrame([(1, "k", day), (2, "k", dt.date(2025, 1, 1)), (3, None, day), (4, "x", None)], "i int, k string, d date")
    got = {r["i"]: r["t"] for r in lookup.point_in_time(facts, dim, "k", "d").collect()}
    assert got == {1: "A", 2: None, 3: None, 4: None}


# --- corrected and re-delivered files -----------------------------------------------

def dimension_rows(spark, base):
    return sorted((r["user_id"], r["event_type"], str(r[START_COL]), r[CURRENT_COL]) for r in jobs.read_dimension(spark, base).collect())


def test_a_changed_file_is_loaded_again(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "b")
    put(src, "2025-01-01", [event(1, "2025-01-01T10:00:00.000000", 7, "silver")])
    assert jobs.run_batch(spark, manifest(spark, src), feed(), base, 1)["files"] == 1
    assert jobs.run_batch(spark, manifest(spark, src), feed(), base, 2)["status"] == "nothing_pending"
    put(src, "2025-01-01", [event(1, "2025-01-01T10:00:00.000000", 7, "gold"), event(2, "2025-01-01T09:00:00.000000", 8, "gold")])
    states = {r["state"] for r in Ledger(spark, jobs.Layout(base).ledger).compare(manifest(spark, src).withColumnRenamed("path", "file_name")).collect()}
    assert states == {"changed"}
    assert jobs.run_batch(spark, manifest(spark, src), feed(), base, 3)["files"] == 1
    assert ids(jobs.read_facts(spark, base)) == [1, 2]
    assert dimension_rows(spark, base) == [(7, "gold", "2025-01-01", True), (8, "gold", "2025-01-01", True)]


@pytest.mark.parametrize("again", ["batch", "stream"])
def test_a_corrected_delivery_takes_back_what_it_no_longer_says(spark, tmp_path, again):
    """Key 7 changes against the alphabet, key 8 vanishes, key 9 also stands in another file and falls back to it."""
    src, base = str(tmp_path / "src"), str(tmp_path / "b")
    put(src, "2025-01-01", [event(1, "2025-01-01T10:00:00.000000", 9, "plain")])
    put(src, "2025-01-02", [event(2, "2025-01-02T10:00:00.000000", 7, "gold"), event(3, "2025-01-02T10:00:00.000000", 8, "gold"),
                            event(4, "2025-01-02T10:00:00.000000", 9, "gold")])
    run = (lambda n: jobs.run_stream(spark, src, feed(), base, str(tmp_path / f"c{n}"))) if again == "stream" else (
        lambda n: jobs.run_batch(spark, manifest(spark, src), feed(), base, n))
    run(1)
    assert [r[:2] for r in dimension_rows(spark, base)] == [(7, "gold"), (8, "gold"), (9, "gold"), (9, "plain")]
    put(src, "2025-01-02", [event(2, "2025-01-02T10:00:00.000000", 7, "bronze")])
    run(2)
    assert ids(jobs.read_facts(spark, base)) == [1, 2]
    assert dimension_rows(spark, base) == [(7, "bronze", "2025-01-02", True), (9, "plain", "2025-01-01", True)]
    # a delivery without any row left takes everything back
    put(src, "2025-01-02", ["{broken"])
    if again == "batch":
        jobs.run_batch(spark, manifest(spark, src), feed(), base, 3, on_fail="quarantine")
    else:
        run(3)
    assert dimension_rows(spark, base) == [(9, "plain", "2025-01-01", True)]


@pytest.mark.parametrize("compact_every", [2, 64])
def test_history_equals_a_build_over_last_deliveries(spark, tmp_path, compact_every):
    """Random deliveries of five files in any order, some again with other rows: after each, the build over what counts."""
    import random

    rnd = random.Random(compact_every)
    hs = HistoryStream(spark, str(tmp_path / "h"), "k", ["t"], ["t"], ["ts"], compact_every=compact_every, buckets=2)
    schema = "k long, day date, ts timestamp_ntz, t string, _file string"
    told = {}
    for n in range(9):
        f = f"f{rnd.randrange(5)}"
        day = 1 + int(f[1])
        told[f] = [(k, dt.date(2025, 1, day), dt.datetime(2025, 1, day, rnd.randrange(24)), rnd.choice("ABC"), f) for k in rnd.sample(range(4), rnd.randrange(4))]
        hs.process(spark.createDataFrame(told[f], schema), n, files=spark.createDataFrame([(f,)], "_file string"))
        hs.process(spark.createDataFrame(told[f], schema), n, files=spark.createDataFrame([(f,)], "_file string"))  # replay
        rows = [r for rs in told.values() for r in rs]
        want = scd2.build(spark.createDataFrame(rows, schema).select("k", "day", "t"), "k", "day", ["t"]).collect()
        dim = hs.dimension.read()
        cols = ["k", "t", START_COL, END_COL, CURRENT_COL]
        got = [] if dim is None else dim.select(cols).collect()
        assert sorted(map(tuple, got)) == sorted(tuple(r[c] for c in cols) for r in want), n
    if compact_every == 2:
        assert len(os.listdir(tmp_path / "h" / "snapshots")) <= 4


def test_ledger_tells_new_changed_done_and_vanished(spark, tmp_path):
    led = Ledger(spark, str(tmp_path / "l"))
    schema = "file_name string, file_date date, length long, modified timestamp"
    t = lambda h: dt.datetime(2025, 1, 5, h)
    d = dt.date(2025, 1, 1)
    first = spark.createDataFrame([("a", d, 10, t(1)), ("b", d, 10, t(1)), ("c", d, 10, t(1)), ("gone", d, 5, t(1))], schema)
    led.record(first.withColumn("rows", F.lit(1)), 1, token="batch~1")
    now = spark.createDataFrame([("a", d, 10, t(1)), ("b", d, 11, t(1)), ("c", d, 10, t(2)), ("new", d, 1, t(3))], schema)
    state = {r["file_name"]: r["state"] for r in led.compare(now).collect()}
    assert state == {"a": "done", "b": "changed", "c": "changed", "new": "new", "gone": "vanished"}
    assert sorted(r["file_name"] for r in led.pending(now).collect()) == ["b", "c", "new"]
    led.record(now.where("file_name in ('b', 'c')").withColumn("rows", F.lit(2)), 2, token="batch~2")
    led.record(now.where("file_name in ('b', 'c')").withColumn("rows", F.lit(2)), 2, token="batch~2")  # replay
    assert [r["file_name"] for r in led.pending(now).collect()] == ["new"] and led.read().count() == 6
    # paths alone, as before: known files are done
    assert [r["file_name"] for r in led.pending(now.select("file_name", "file_date")).collect()] == ["new"]
    assert led.compact(least=2) and len(os.listdir(tmp_path / "l")) == 1
    assert [r["file_name"] for r in led.pending(now).collect()] == ["new"]
    assert led.seen_token("batch~1") and led.seen_batch(2) and not led.seen_token("batch~3")


# --- reading less ----------------------------------------------------------------------

def leaves(df):
    """Scan nodes of an executed plan, with their metrics."""
    jvm = df.sparkSession.sparkContext._jvm
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind == "FileSourceScanExec":
            out.append(node)
        else:
            kids = node.children()
            todo += [kids.apply(i) for i in range(kids.size())]
    assert jvm is not None
    return out


def test_two_pending_files_a_year_apart_parse_two_folders(spark, tmp_path):
    src = str(tmp_path / "src")
    for i, day in enumerate(["2024-01-01", "2024-03-01", "2024-06-01", "2024-09-01", "2025-01-01"]):
        put(src, day, [event(i, f"{day}T10:00:00.000000", i)])
    listed = manifest(spark, src).where("file_date in ('2024-01-01', '2025-01-01')").withColumnRenamed("path", "file_name")
    listed.write.parquet(str(tmp_path / "intent"))
    rows = jobs._read_listed(spark, feed(), spark.read.parquet(str(tmp_path / "intent")))
    assert "dynamicpruning" in rows._jdf.queryExecution().toString()
    assert ids(rows) == [0, 4]
    got = rows.select("event_id", "file_name")
    got.collect()
    scans = [n for n in leaves(got) if "json" in n.relation().fileFormat().toString().lower()]
    assert [n.metrics().apply("numFiles").value() for n in scans] == [2]


@pytest.mark.parametrize("layout", ["named", "nested"])
def test_files_dated_by_their_names_only(spark, tmp_path, layout):
    src = tmp_path / "src"
    for i, day in enumerate(["2024-01-01", "2024-03-01", "2025-01-01"]):
        d = src / day.replace("-", "/") if layout == "nested" else src
        d.mkdir(parents=True, exist_ok=True)
        (d / f"transactions_{day}.json").write_text(event(i, f"{day}T10:00:00.000000", i) + "\n")
    got = files.manifest(spark, str(src), recursive=layout == "nested")
    assert jobs._roots(got.withColumnRenamed("path", "file_name")) == ([f"file:{src}"], layout == "nested")
    listed = got.where("file_date <> '2024-03-01'")
    assert jobs.run_batch(spark, listed, feed(), str(tmp_path / "b"), 1)["files"] == 2
    assert ids(jobs.read_facts(spark, str(tmp_path / "b"))) == [0, 2]


def test_a_date_filter_opens_one_folder_of_facts_before_and_after_compaction(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path / "b")
    for n, day in enumerate(["2025-01-01", "2025-01-02", "2025-01-01", "2025-01-03"]):
        put(src, day, [event(10 * n + i, f"{day}T10:00:00.000000", i) for i in range(3)], f"transactions_{day}_{n}.json")
        jobs.run_batch(spark, manifest(spark, src), feed(), base, n)
    put(src, "2025-01-02", [event(10, "2025-01-02T10:00:00.000000", 1)], "transactions_2025-01-02_1.json")
    jobs.run_batch(spark, manifest(spark, src), feed(), base, 9)
    want = [0, 1, 2, 10, 20, 21, 22, 30, 31, 32]
    first = dt.date(2025, 1, 1)

    def day_folders():
        one = jobs.read_facts(spark, base).where(F.col("fact_date") == F.lit(first)).select("event_id")
        assert ids(one) == [0, 1, 2, 20, 21, 22]
        one.collect()
        (scan,) = [n for n in leaves(one) if "fact_date" in n.relation().partitionSchema().simpleString()]
        return scan.metrics().apply("numPartitions").value()

    assert ids(jobs.read_facts(spark, base)) == want and day_folders() == 2
    assert jobs.compact_facts(spark, base, feed(), first, dt.date(2025, 1, 2)) == 7
    assert ids(jobs.read_facts(spark, base)) == want and day_folders() == 1
    assert len(os.listdir(f"{base}/fact/fact_date=2025-01-02")) == 1
    # a later batch adds its own part
    put(src, "2025-01-01", [event(50, "2025-01-01T11:00:00.000000", 1)], "transactions_2025-01-01_5.json")
    jobs.run_batch(spark, manifest(spark, src), feed(), base, 10)
    assert ids(jobs.read_facts(spark, base)) == [*want, 50]


def test_a_compaction_that_was_cut_short_is_finished_by_the_reader(spark, tmp_path, monkeypatch):
    src, base = str(tmp_path / "src"), str(tmp_path / "b")
    put(src, "2025-01-01", [event(i, "2025-01-01T10:00:00.000000", 1) for i in range(3)])
    jobs.run_batch(spark, manifest(spark, src), feed(), base, 1)
    with monkeypatch.context() as m:
        m.setattr(writers, "move_path", lambda *a: (_ for _ in ()).throw(OSError("cut")))
        with pytest.raises(OSError):
            jobs.compact_facts(spark, base, feed(), dt.date(2025, 1, 1), dt.date(2025, 1, 1))
    assert ids(jobs.read_facts(spark, base)) == [0, 1, 2]
    assert not os.path.exists(f"{base}/_compaction")


def test_open_rows_meet_the_stage_without_an_exchange(spark, tmp_path):
    dim = Dimension(spark, str(tmp_path / "d"), "k", buckets=3)
    daily = spark.createDataFrame([(k, dt.date(2025, 1, d), "AB"[(k * d) % 2]) for k in range(50) for d in (1, 2)], "k long, day date, t string")
    dim.commit(scd2.build(daily.where("day = '2025-01-01'"), "k", "day", ["t"]))
    stage = dim.aligned(scd2.staged_from_daily(daily.where("day = '2025-01-02'"), "day"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for merge in (scd2.expire, scd2.merge_day):
            out = merge(dim.read(), stage, "k", ["t"])
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan and plan.count("Exchange ") == 1 and "REPARTITION_BY_NUM" in plan
        # rows that pass on to the next version are written where they are
        _, untouched = scd2.extend_open_parts(dim.read_current(), dim.aligned(daily.where("k < 5")), "k", "day", ["t"])
        plan = untouched.repartition(3, "k")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    want = scd2.merge_day(dim.read(), stage, "k", ["t"])
    assert sorted(map(tuple, want.select("k", "t", START_COL, END_COL).collect())) == sorted(
        map(tuple, scd2.build(daily, "k", "day", ["t"]).select("k", "t", START_COL, END_COL).collect()))


def test_archive_moves_in_tasks_and_again_does_nothing(spark, tmp_path):
    src, kept = str(tmp_path / "src dir"), str(tmp_path / "kept")
    for d in range(1, 10):
        put(src, f"2025-01-0{d}", [event(d, f"2025-01-0{d}T10:00:00.000000", 1)])
    listed = files.manifest(spark, src).select(F.col("path").alias("file_name"))
    listed.write.parquet(str(tmp_path / "list"))
    listed = spark.read.parquet(str(tmp_path / "list"))
    assert files.archive(spark, listed, kept) == 9
    assert files.archive(spark, listed, kept) == 0
    assert sorted(os.listdir(kept)) == [f"file_date=2025-01-0{d}" for d in range(1, 10)]
    assert os.path.exists(f"{kept}/file_date=2025-01-03/transactions_2025-01-03.json")
