"""Sources, shape, quality and sinks on literal fixtures (FIXTURES.md §5-7)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from chronoset.functions.scalar import amount_decimal, date_list, parse_date, parse_raw_timestamp
from chronoset.operators import quality
from chronoset.operators.shape import customer_snapshot, normalise_fact, txn_flatten
from chronoset.sinks import writers
from chronoset.sinks.ledger import Ledger
from chronoset.sources import files, json_scan


def profile(cid, tier="Gold"):
    return {"customer_id": cid, "customer_name": "N", "customer_address": "1 St", "customer_city": "C",
            "customer_state": "S", "customer_zip": "1", "customer_tier": tier, "customer_email": "e@x"}


def txn(tid, ts, amount, cust):
    return {"transaction_id": tid, "transaction_timestamp": ts, "amount": amount, "currency": "USD",
            "merchant_id": "M1", "merchant_category": "Travel", "card_type": "Visa",
            "transaction_status": "approved", "customer_info": cust}


def write_lines(path, records, blank_lines=False, extra=None):
    with open(path, "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")
            if blank_lines:
                f.write("\n")
        if extra:
            f.write(extra + "\n")


def test_scan_flatten_snapshot(spark, tmp_path):
    p = tmp_path / "transactions_2025-01-02.json"
    recs = [txn("t1", "2025-01-02T00:10:00Z", 10.5, profile("c1")),
            txn("t2", "2025-01-02T13:00:00Z", "7.25", profile("c1")),
            txn("t3", "2025-01-02T14:00:00Z", None, profile("c2", "Silver"))]
    write_lines(p, recs, blank_lines=True, extra="{not json")
    raw = json_scan.read_json(spark, str(p))
    good, bad = json_scan.split_corrupt(raw)
    # (a count alone would touch only the corrupt column, which Spark refuses
    # on raw JSON; any real use reads data columns too)
    assert len(good.collect()) == 3 and len(bad.collect()) == 1
    assert {r["file_date"] for r in good.collect()} == {dt.date(2025, 1, 2)}
    fact = normalise_fact(txn_flatten(good))
    rows = {r["transaction_id"]: r for r in fact.collect()}
    assert rows["t2"]["amount_num"] == pytest.approx(7.25)
    assert rows["t3"]["amount_num"] is None
    assert rows["t1"]["customer_id"] == "c1"
    snap = customer_snapshot(good, "file_date")
    assert snap.count() == 2  # c1 twice with the same profile -> one row
    assert {r["effective_end_date"] for r in snap.collect()} == {dt.date(3000, 12, 31)}


def test_date_as_written_in_western_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2025-01-02T00:10:00Z",)], "t string")
        r = df.select(F.to_date(parse_raw_timestamp("t")).alias("d")).first()
        assert r["d"] == dt.date(2025, 1, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_amount_normalisation(spark):
    df = spark.createDataFrame([(None,), ("0.0",), ("-3.0",), ("7.25",), ("nan",), ("x",)], "a string")
    got = [r[0] for r in df.select(amount_decimal("a")).collect()]
    assert [None if g is None else float(g) for g in got] == [None, 0.0, -3.0, 7.25, None, None]
    classes = {r["amount_class"]: r["n_rows"] for r in quality.amount_classes(df, "a").collect()}
    assert classes == {"null": 1, "zero": 1, "negative": 1, "positive": 1, "not_numeric": 2}


def test_multiline_array(spark, tmp_path):
    p = tmp_path / "transactions_2025-01-03.json"
    p.write_text(json.dumps([txn("t1", "2025-01-03T01:00:00Z", 1, profile("c1")),
                             txn("t2", "2025-01-03T02:00:00Z", 2, profile("c2"))], indent=2))
    assert json_scan.read_json(spark, str(p), multiline=True, corrupt=False).count() == 2


def test_file_name_cases(spark):
    names = ["transactions_2025-01-01.json", "sub/transactions_2025-01-01.json",
             "xtransactions_2025-01-01.json.bak", "transactions_20250101.json", "notes.txt"]
    out = files.file_dates(spark.createDataFrame([(n,) for n in names], "file_name string")).collect()
    assert sorted(r["file_name"] for r in out) == sorted(names[:3])
    assert files.latest_date(spark.createDataFrame([(n,) for n in names], "file_name string")).first()[0] == \
        dt.date(2025, 1, 1)


def test_date_list_guard(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 3), dt.date(2025, 1, 1)), (dt.date(2025, 1, 1), dt.date(2025, 1, 3))],
                               "s date, e date")
    got = [len(r[0]) for r in df.select(date_list("s", "e")).collect()]
    assert got == [0, 3]
    assert [r[0] for r in spark.createDataFrame([("2025-02-30",), ("2025-01-05",)], "t string")
            .select(parse_date("t")).collect()] == [None, dt.date(2025, 1, 5)]


def test_listing_and_manifest(spark, tmp_path):
    for n in ["transactions_2025-01-01.json", "transactions_2025-01-02.json", "notes.txt"]:
        (tmp_path / n).write_text("{}\n")
    listing = files.list_files(spark, str(tmp_path), prefix="transactions_")
    assert sorted(r["file_name"] for r in listing.collect()) == ["transactions_2025-01-01.json",
                                                                 "transactions_2025-01-02.json"]
    dates = files.file_dates(listing).collect()
    assert [r["file_date"] for r in dates] == [dt.date(2025, 1, 1), dt.date(2025, 1, 2)]


def test_quality_gate(spark):
    good = spark.createDataFrame([("t1", "c1"), ("t2", "c2")], "transaction_id string, customer_id string")
    ok, res = quality.gate(good, quality.default_rules())
    assert ok and len(res) == 3
    bad = spark.createDataFrame([("t1", None)], "transaction_id string, customer_id string")
    with pytest.raises(quality.CheckFailed):
        quality.gate(bad, quality.default_rules())
    ok, _ = quality.gate(bad, quality.default_rules(), on_fail="skip")
    assert not ok
    empty = good.limit(0)
    res = {r["rule"]: r["status"] for r in quality.run_checks(empty, quality.default_rules()).collect()}
    assert res["non_empty"] == "Failure"


def test_null_struct_fails_before_load(spark, tmp_path):
    p = tmp_path / "transactions_2025-01-04.json"
    write_lines(p, [txn("t1", "2025-01-04T01:00:00Z", 1, None)])
    raw = json_scan.read_json(spark, str(p))
    flat = txn_flatten(raw)
    with pytest.raises(quality.CheckFailed):
        quality.gate(flat, quality.default_rules())


def test_observed_rules_ride_along_with_write(spark, tmp_path):
    df = spark.createDataFrame([("t1", "c1"), ("t2", None)], "transaction_id string, customer_id string")
    rules = quality.default_rules()
    obs_df, obs = quality.observed(df, rules)
    obs_df.write.parquet(str(tmp_path / "out"))
    res = quality.observation_results(obs, rules)
    assert res[0]["metric"] == 2.0 and res[2]["metric"] == 0.5


def test_replace_by_date_idempotent_and_empty_day(spark, tmp_path):
    path = str(tmp_path / "fact")
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    df = spark.createDataFrame([("a", d1, 1.0), ("b", d2, 2.0)], "id string, transaction_date date, v double")
    writers.replace_by_date(df, path, "transaction_date")
    again = spark.createDataFrame([("c", d2, 3.0)], "id string, transaction_date date, v double")
    writers.replace_by_date(again, path, "transaction_date")
    writers.replace_by_date(again, path, "transaction_date")
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == ["a", "c"]
    # reload of d1 with zero rows empties that day
    writers.replace_by_date(again.limit(0), path, "transaction_date", dates=[d1])
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == ["c"]


def test_append_and_overwrite_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5).withColumn("d", F.lit(dt.date(2025, 1, 1)))
    assert writers.load_append(df, path) == 5
    assert writers.load_append(df, path) == 5
    assert spark.read.parquet(path).count() == 10
    assert writers.load_overwrite(df.limit(2), path) == 2
    assert spark.read.parquet(path).count() == 2


def test_dimension_versions(spark, tmp_path):
    from chronoset.sinks.dimension import Dimension

    dim = Dimension(spark, str(tmp_path / "dim"), "k", buckets=2)
    assert dim.version() == 0 and dim.read() is None and dim.read_current() is None
    v1 = spark.createDataFrame([("a", True), ("b", False)], "k string, is_current boolean")
    dim.commit(v1)
    dim.commit(dim.read().where("k = 'a'"))  # computed from v1, written as v2
    assert dim.version() == 2
    assert [r["k"] for r in dim.read_current().collect()] == ["a"]
    assert dim.read(1).count() == 2
    # any session finds the tables by the pointer alone
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("dim_")]:
        spark.sql(f"DROP TABLE {name}")
    assert Dimension(spark, str(tmp_path / "dim")).read().count() == 1


def test_dimension_closed_rows_stay_where_they_are_until_compaction(spark, tmp_path):
    from chronoset.operators import scd2
    from chronoset.sinks.dimension import Dimension

    rows = [(k, dt.date(2025, 1, d), t) for k in "abc" for d in range(1, 9) for t in ["A" if (d * ord(k)) % 3 else "B"]]
    daily = spark.createDataFrame(rows, "k string, day date, tier string")
    dim = Dimension(spark, str(tmp_path / "dim"), "k", buckets=2, compact_every=3)
    key = lambda r: (r["k"], r["effective_start_date"])
    built = lambda d: sorted(scd2.build(daily.where(f"day <= '2025-01-0{d}'"), "k", "day", ["tier"]).collect(), key=key)
    dim.commit(scd2.build(daily.where("day <= '2025-01-02'"), "k", "day", ["tier"]), max_day=dt.date(2025, 1, 2))
    for d in range(3, 9):
        st = dim.state()
        batch = dim.aligned(daily.where(f"day = '2025-01-0{d}'"))
        rebuilt, untouched = scd2.extend_open_parts(dim.read_current(st), batch, "k", "day", ["tier"])
        dim.commit([untouched, rebuilt], replace=False, state=st, max_day=dt.date(2025, 1, d))
        assert sorted(dim.read().collect(), key=key) == built(d)
        assert sorted(dim.read(st["version"]).collect(), key=key) == built(d - 1)
        assert len(dim.state()["closed"]) <= 3 and dim.state()["max_day"] == dt.date(2025, 1, d)
    assert dim.read_current().count() == 3 and dim.version() == 7
    # folders that neither of the last two versions reads are gone
    left = {int(n.split("=")[1]) for n in os.listdir(tmp_path / "dim" / "versions")}
    assert left == {7, 6, *dim.state()["closed"], *dim._at(6)["closed"]}


def test_a_version_without_its_pointer_is_overwritten(spark, tmp_path, monkeypatch):
    from chronoset.sinks import dimension

    dim = dimension.Dimension(spark, str(tmp_path / "dim"), "k", buckets=2)
    dim.commit(spark.createDataFrame([("a", True)], "k string, is_current boolean"))
    with monkeypatch.context() as m:
        m.setattr(dimension.Dimension, "_pointer", lambda self, v: (_ for _ in ()).throw(OSError("cut")))
        with pytest.raises(OSError):
            dim.commit(spark.createDataFrame([("b", True)], "k string, is_current boolean"), state={**dimension.EMPTY, "version": 1, "closed": [1]})
    assert [r["k"] for r in dim.read().collect()] == ["a"]
    dim.commit(spark.createDataFrame([("c", True)], "k string, is_current boolean"))
    assert [r["k"] for r in dim.read().collect()] == ["c"]


def test_ledger_pending(spark, tmp_path):
    led = Ledger(spark, str(tmp_path / "ledger"))
    manifest = spark.createDataFrame(
        [("transactions_2025-01-01.json", dt.date(2025, 1, 1)), ("transactions_2025-01-02.json", dt.date(2025, 1, 2))],
        "file_name string, file_date date")
    assert led.pending(manifest).count() == 2
    led.record(manifest.where("file_date = '2025-01-01'").withColumn("rows", F.lit(3)), batch_id=7)
    assert [r["file_name"] for r in led.pending(manifest).collect()] == ["transactions_2025-01-02.json"]
    assert led.seen_batch(7) and not led.seen_batch(8)
    assert os.path.isdir(str(tmp_path / "ledger"))


def test_conformance_digit_guard_equals_try_cast(spark):
    from chronoset.operators.quality import converts

    vals = [" 12 ", "+5", "-0", "1.5", "abc", "", "١٢", "NaN", "Infinity", "1e3", "2025-01-31", "2025-13-01",
            "true", "12abc", None, "9223372036854775808", "0x1F", "  "]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    for t in ["tinyint", "int", "bigint", "decimal(10,2)", "double", "date", "timestamp", "boolean"]:
        got = df.select(converts(F.col("t"), t).alias("g"), F.col("t").try_cast(t).alias("w")).collect()
        assert [str(r["g"]) for r in got] == [str(r["w"]) for r in got], t


def test_checkpoint_root_requires_a_shared_folder_on_a_cluster():
    import pytest as _pytest

    from chronoset.session import checkpoint_root

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Ctx:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return _Conf()

    class _Session:
        sparkContext = _Ctx()
        conf = _Conf()

    with _pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session())
