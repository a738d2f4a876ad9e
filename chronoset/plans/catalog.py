"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the given tables (or files Spark writes from them) in
full; writes go to fresh folders under the session's checkpoint directory.
The matching DuckDB formulations live in `chronoset.plans.sql`.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoset.functions.scalar import (
    amount_class, file_name_for, format_timestamp, parse_date, parse_raw_timestamp, raw_timestamp_text)
from chronoset.operators import changes, drift, lookup, quality, sampling, scd2
from chronoset.operators.check_states import CheckStates
from chronoset.operators.shape import customer_snapshot, txn_flatten
from chronoset.plans import feeds
from chronoset.plans.feeds import E_ATTRS, E_DAY, E_KEY, E_TRACKED
from chronoset.schemas import START_COL
from chronoset.session import scratch_path
from chronoset.sinks import writers
from chronoset.sinks.dimension import Dimension
from chronoset.sinks.ledger import Ledger
from chronoset.sources import files, json_scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SEED = "s42"
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _daily(spark, sf_dir, planted_nulls=False):
    return feeds.events_daily(spark, sf_dir, planted_nulls)


def _dim(spark, sf_dir, tracked=None, mode=scd2.CHANGED_ONLY):
    return scd2.build_history(_daily(spark, sf_dir), E_KEY, E_DAY, tracked or E_TRACKED, mode, E_ATTRS)


def _last_day(spark, sf_dir):
    """The feed's last day: a scan-only aggregate (the daily rows' days are the
    events' dates, so the daily reduction is not needed to find it)."""
    return feeds.events(spark, sf_dir).agg(F.max(F.to_date("ts"))).first()[0]


def _stored(spark, dimension: DataFrame) -> tuple[DataFrame, Dimension]:
    """The dimension, read back from its bucketed table: what a merge or fold meets in practice."""
    kept = Dimension(spark, scratch_path(spark, "dim"), E_KEY)
    kept.commit(dimension)
    return kept.read().select(E_KEY, *E_ATTRS, *scd2.BOOK_COLS), kept


def _prior_and_stage(spark, sf_dir, mode=scd2.CHANGED_ONLY):
    """Dimension built from every day before the feed's last day and stored, and that day staged."""
    daily = _daily(spark, sf_dir)
    last = _last_day(spark, sf_dir)
    prior, kept = _stored(spark, scd2.build_history(daily.where(F.col(E_DAY) < F.lit(last)), E_KEY, E_DAY, E_TRACKED, mode, E_ATTRS))
    stage = scd2.staged_from_daily(daily.where(F.col(E_DAY) == F.lit(last)), E_DAY)
    return prior, kept.aligned(stage)


# --- history ---------------------------------------------------------------

@register("latest_profile_per_day")
def q_latest_profile_per_day(spark, sf_dir):
    return _daily(spark, sf_dir)


@register("scd2_build")
def q_scd2_build(spark, sf_dir):
    return _dim(spark, sf_dir)


@register("scd2_build_multi")
def q_scd2_build_multi(spark, sf_dir):
    return _dim(spark, sf_dir, ["event_type", "props"])


@register("scd2_append_all")
def q_scd2_append_all(spark, sf_dir):
    return _dim(spark, sf_dir, mode=scd2.APPEND_ALL)


@register("scd2_append_all_nulls")
def q_scd2_append_all_nulls(spark, sf_dir):
    daily = _daily(spark, sf_dir, planted_nulls=True)
    return scd2.build_append_all(daily, E_KEY, E_DAY, ["event_type", "props"], E_ATTRS)


@register("scd2_current")
def q_scd2_current(spark, sf_dir):
    kept = Dimension(spark, scratch_path(spark, "dim"), E_KEY)
    kept.commit(_dim(spark, sf_dir))
    return kept.read_current().select(E_KEY, *E_ATTRS, *scd2.BOOK_COLS)


@register("scd2_changed_columns")
def q_scd2_changed_columns(spark, sf_dir):
    return scd2.changed_columns(_dim(spark, sf_dir, ["event_type", "props"]), E_KEY, ["event_type", "props"])


@register("scd2_changed_rows")
def q_scd2_changed_rows(spark, sf_dir):
    """Every daily row but a key's first against the row that was open before it, the key's previous row."""
    dn = _daily(spark, sf_dir, planted_nulls=True)
    nxt = F.lead(E_DAY).over(Window.partitionBy(E_KEY).orderBy(E_DAY))
    before = dn.withColumn("__until", nxt).where("__until is not null").drop(E_DAY).withColumnRenamed("__until", E_DAY)
    return scd2.changed_rows(before, dn, [E_KEY, E_DAY], ["event_type", "props"])


@register("scd2_expire")
def q_scd2_expire(spark, sf_dir):
    prior, stage = _prior_and_stage(spark, sf_dir)
    return scd2.expire(prior, stage, E_KEY, E_TRACKED)


@register("scd2_insert_all")
def q_scd2_insert_all(spark, sf_dir):
    prior, stage = _prior_and_stage(spark, sf_dir)
    return scd2.insert_versions(scd2.expire(prior, stage, E_KEY, E_TRACKED), stage)


@register("scd2_merge_day")
def q_scd2_merge_day(spark, sf_dir):
    prior, stage = _prior_and_stage(spark, sf_dir)
    return scd2.merge_day(prior, stage, E_KEY, E_TRACKED)


@register("scd2_merge_day_append_all")
def q_scd2_merge_day_append_all(spark, sf_dir):
    prior, stage = _prior_and_stage(spark, sf_dir, scd2.APPEND_ALL)
    return scd2.merge_day(prior, stage, E_KEY, E_TRACKED, scd2.APPEND_ALL)


def _split_day(spark, sf_dir):
    """The feed's tenth day."""
    return feeds.events(spark, sf_dir).agg(F.date_add(F.min(F.to_date("ts")), 9)).first()[0]


def _stored_and_rest(spark, sf_dir):
    """A stored dimension of the feed's first ten days, and the daily rows of the others."""
    daily = _daily(spark, sf_dir)
    cut = F.lit(_split_day(spark, sf_dir))
    prior, _ = _stored(spark, scd2.build(daily.where(F.col(E_DAY) <= cut), E_KEY, E_DAY, E_TRACKED, E_ATTRS))
    return prior, daily.where(F.col(E_DAY) > cut), daily


@register("scd2_fold_days")
def q_scd2_fold_days(spark, sf_dir):
    prior, rest, _ = _stored_and_rest(spark, sf_dir)
    return scd2.fold_days(prior, rest, E_KEY, E_DAY, E_TRACKED)


@register("scd2_apply_days")
def q_scd2_apply_days(spark, sf_dir):
    """The later days are stored first, then the first ten days arrive late."""
    daily = _daily(spark, sf_dir)
    cut = F.lit(_split_day(spark, sf_dir))
    stored, _ = _stored(spark, scd2.build(daily.where(F.col(E_DAY) > cut), E_KEY, E_DAY, E_TRACKED, E_ATTRS))
    return scd2.apply_days(stored, daily, daily.where(F.col(E_DAY) <= cut), E_KEY, E_DAY, E_TRACKED)


@register("union_changed_new")
def q_union_changed_new(spark, sf_dir):
    """Rows that differ from their key's previous row, and first rows: one pass over the key's days."""
    daily = _daily(spark, sf_dir)
    w = Window.partitionBy(E_KEY).orderBy(E_DAY)
    first = F.lag(F.lit(1)).over(w).isNull()
    differs = scd2.changed([F.lag(c).over(w) for c in E_TRACKED], [F.col(c) for c in E_TRACKED])
    kind = F.when(first, F.lit("new")).when(differs, F.lit("changed"))
    return daily.withColumn("kind", kind).where("kind is not null").select(E_KEY, E_DAY, *E_ATTRS, "kind")


# --- reading the history --------------------------------------------------------

@register("sample_current")
def q_sample_current(spark, sf_dir):
    # one open row a key: a quarter of the open rows are the open rows of a quarter of the keys
    sampled = sampling.key_sample(feeds.events(spark, sf_dir), E_KEY, 0.25, SEED)
    return scd2.current(_dim(spark, sf_dir)).where(sampled)


@register("sample_profiles")
def q_sample_profiles(spark, sf_dir):
    sampled = sampling.key_sample(feeds.events(spark, sf_dir), E_KEY, 0.15, SEED)
    return sampling.one_per_key(_daily(spark, sf_dir).where(sampled), E_KEY, SEED).select(E_KEY, E_DAY, *E_ATTRS)


def _o_names(spark, sf_dir) -> DataFrame:
    """A listing built from the order dates: each date's daily file name plus
    names that must or must not match the pattern."""
    d = feeds.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    ymd = F.date_format("d", "yyyy-MM-dd")
    return d.select(F.explode(F.array(
        file_name_for(F.col("d")),
        F.concat(F.lit("sub/transactions_"), ymd, F.lit(".json")),
        F.concat(F.lit("xtransactions_"), ymd, F.lit(".json.bak")),
        F.concat(F.lit("transactions_"), F.date_format("d", "yyyyMMdd"), F.lit(".json")),
        F.concat(F.lit("notes_"), ymd, F.lit(".txt")),
    )).alias("file_name"))


@register("sample_files")
def q_sample_files(spark, sf_dir):
    found = files.file_dates(_o_names(spark, sf_dir))
    return sampling.sample_k(found, ["file_name"], 4, SEED)


@register("asof_lookup")
def q_asof_lookup(spark, sf_dir):
    ev = feeds.events(spark, sf_dir).select("event_id", "ts", "user_id", "value").withColumn("__d", F.to_date("ts"))
    dim = _dim(spark, sf_dir)
    out = lookup.point_in_time(ev, dim, E_KEY, "__d", ["event_type"])
    return out.select("event_id", "ts", "user_id", "value", "event_type", START_COL)


@register("dim_integrity")
def q_dim_integrity(spark, sf_dir):
    return lookup.integrity(_dim(spark, sf_dir, mode=scd2.APPEND_ALL), E_KEY)


# --- shape -----------------------------------------------------------------

O_FLAT = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority"]


def _read_back_flat(nested: DataFrame) -> DataFrame:
    return nested.select(*O_FLAT, *[F.col(f"customer_info.{c}").alias(c) for c in feeds.O_PROFILE])


@register("txn_nest")
def q_txn_nest(spark, sf_dir):
    return _read_back_flat(feeds.orders_nested(spark, sf_dir))


@register("txn_flatten")
def q_txn_flatten(spark, sf_dir):
    nested = feeds.orders_nested(spark, sf_dir)
    flat = txn_flatten(nested, "customer_info", "c_custkey", "o_orderdate",
                       columns=[*O_FLAT[:2], "transaction_date", *O_FLAT[2:], "c_custkey"])
    return flat.withColumnRenamed("c_custkey", "customer_id")


@register("customer_snapshot")
def q_customer_snapshot(spark, sf_dir):
    nested = feeds.orders_nested(spark, sf_dir).withColumn("file_date", F.to_date("o_orderdate"))
    return customer_snapshot(nested, "file_date")


def _o_raw(spark, sf_dir) -> DataFrame:
    """Feed O in the raw file layout: timestamp as text, plus its file date."""
    return (feeds.orders_nested(spark, sf_dir)
            .withColumn("file_date", F.to_date("o_orderdate"))
            .withColumn("o_orderdate", raw_timestamp_text("o_orderdate")))


O_RAW_SCHEMA = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, "
                "o_orderpriority string, customer_info struct<c_custkey: long, c_name: string, c_nationkey: int, "
                "c_acctbal: double, c_mktsegment: string>")


@register("json_text_roundtrip")
def q_json_text_roundtrip(spark, sf_dir):
    """Rows to JSON text and back, without files."""
    from pyspark.sql.types import _parse_datatype_string

    text = json_scan.to_json_text(_o_raw(spark, sf_dir).drop("file_date"), keep_nulls=True)
    back = json_scan.parse_json_text(text, "value", _parse_datatype_string(O_RAW_SCHEMA)).select("record.*")
    return _read_back_flat(back.withColumn("o_orderdate", parse_raw_timestamp("o_orderdate")))


@register("json_roundtrip")
def q_json_roundtrip(spark, sf_dir):
    from pyspark.sql.types import _parse_datatype_string

    path = scratch_path(spark, "json")
    writers.write_counted(_o_raw(spark, sf_dir).drop("file_date"), path, "overwrite", fmt="json",
                          options={"ignoreNullFields": "false"})
    back = json_scan.read_json(spark, path, _parse_datatype_string(O_RAW_SCHEMA), with_file=False)
    good, _bad = json_scan.split_corrupt(back)
    return _read_back_flat(good.withColumn("o_orderdate", parse_raw_timestamp("o_orderdate")))


E_NESTED_SCHEMA = ("event_id long, ts timestamp_ntz, value double, "
                   "profile struct<user_id: long, event_type: string, props: string>")


def _nested_events(spark, sf_dir) -> DataFrame:
    return feeds.events(spark, sf_dir).select(
        "event_id", "ts", "value", F.struct("user_id", "event_type", "props").alias("profile"),
        F.to_date("ts").alias("file_date"))


def _write_events_daily_json(spark, sf_dir) -> str:
    path = scratch_path(spark, "events-json")
    writers.write_daily_json(_nested_events(spark, sf_dir), path, "file_date")
    return path


@register("profiles_from_files")
def q_profiles_from_files(spark, sf_dir):
    from pyspark.sql.types import _parse_datatype_string

    root = _write_events_daily_json(spark, sf_dir)
    # all daily folders as one multi-file read of their root
    return json_scan.read_profiles(spark, root, _parse_datatype_string(E_NESTED_SCHEMA), "profile")


# --- discovery -----------------------------------------------------------------

@register("file_dates")
def q_file_dates(spark, sf_dir):
    return files.file_dates(_o_names(spark, sf_dir))


@register("file_manifest")
def q_file_manifest(spark, sf_dir):
    path = scratch_path(spark, "orders-json")
    writers.write_daily_json(_o_raw(spark, sf_dir), path, "file_date")
    listing = files.list_files(spark, path, "*.json")
    return listing.groupBy("file_date").agg(F.bool_and(F.col("length") > 0).alias("non_empty"))


@register("file_listing")
def q_file_listing(spark, sf_dir):
    """Names and lengths of the daily files whose name starts with a prefix, by name only."""
    made, src = scratch_path(spark, "events-text"), scratch_path(spark, "events-named")
    ev = feeds.events(spark, sf_dir)
    lines = ev.select(F.concat_ws(",", "event_id", "event_type").alias("value"), F.to_date("ts").alias("file_date"))
    lines.repartition("file_date").write.partitionBy("file_date").text(made)
    for folder in writers.list_dirs(spark, made):
        for name in writers.list_files(spark, f"{made}/{folder}"):
            writers.move_path(spark, f"{made}/{folder}/{name}", f"{src}/{folder}/transactions_{folder.split('=', 1)[1]}.json")
    first = feeds.events(spark, sf_dir).agg(F.date_format(F.min("ts"), "yyyy-MM")).first()[0]
    listing = files.list_files(spark, src, "*.json", prefix=f"transactions_{first}-1", full_path=False)
    return listing.select("file_name", "path", "length")


def _o_manifest(spark, sf_dir) -> DataFrame:
    d = feeds.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("file_date")).distinct()
    return d.select(file_name_for("file_date").alias("file_name"), "file_date")


@register("ledger_pending")
def q_ledger_pending(spark, sf_dir):
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    done = (feeds.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
            .select(F.to_date("o_orderdate").alias("file_date")).distinct()
            .select(file_name_for("file_date").alias("file_name"), "file_date", F.lit(None).cast("long").alias("rows")))
    ledger.record(done, batch_id=1)
    return ledger.pending(_o_manifest(spark, sf_dir)).select("file_name", "file_date")


@register("latest_processed_date")
def q_latest_processed_date(spark, sf_dir):
    return files.latest_date(_o_manifest(spark, sf_dir))


def _o_bounds(spark, sf_dir) -> DataFrame:
    return feeds.table(spark, sf_dir, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("start"), F.max(F.to_date("o_orderdate")).alias("end"))


@register("date_spine")
def q_date_spine(spark, sf_dir):
    return files.date_spine(_o_bounds(spark, sf_dir))


@register("missing_dates")
def q_missing_dates(spark, sf_dir):
    """Days without an order file: since the last processed day and from an
    empty ledger, each up to the last order date."""
    present = _o_manifest(spark, sf_dir)
    lo, hi = _o_bounds(spark, sf_dir).first()
    mid = lo + (hi - lo) // 2
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    empty = files.missing_dates(ledger.latest_date(), present, hi, first_day=lo)
    ledger.record(present.where(F.col("file_date") <= F.lit(mid)).withColumn("rows", F.lit(None).cast("long")), batch_id=1)
    since = files.missing_dates(ledger.latest_date(), present, hi)
    return empty.withColumn("ledger", F.lit("empty")).unionByName(since.withColumn("ledger", F.lit("half")))


# --- loads -----------------------------------------------------------------------

def _events_with_day(spark, sf_dir):
    return feeds.events(spark, sf_dir).withColumn("file_date", F.to_date("ts"))


@register("load_append")
def q_load_append(spark, sf_dir):
    ev = _events_with_day(spark, sf_dir)
    path = scratch_path(spark, "load-append")
    writers.load_append(ev.where(F.dayofmonth("ts") <= 15), path, "file_date")
    writers.load_append(ev.where(F.dayofmonth("ts") > 15), path, "file_date")
    return spark.read.parquet(path).select(*EVENT_COLS)


@register("load_overwrite")
def q_load_overwrite(spark, sf_dir):
    ev = _events_with_day(spark, sf_dir)
    path = scratch_path(spark, "load-overwrite")
    writers.load_overwrite(ev.where(F.dayofmonth("ts") <= 15), path, "file_date")
    writers.load_overwrite(ev.where(F.dayofmonth("ts") > 15), path, "file_date")
    return spark.read.parquet(path).select(*EVENT_COLS)


@register("replace_by_date")
def q_replace_by_date(spark, sf_dir):
    ev = _events_with_day(spark, sf_dir)
    path = scratch_path(spark, "replace")
    writers.replace_by_date(ev, path, "file_date")
    reload = ev.where(F.dayofmonth("ts") > 15).withColumn("value", F.col("value") * 2)
    writers.replace_by_date(reload, path, "file_date")
    # a second identical reload changes nothing (idempotent)
    writers.replace_by_date(reload, path, "file_date")
    return spark.read.parquet(path).select(*EVENT_COLS)


# --- parsing ---------------------------------------------------------------------

@register("parse_timestamps")
def q_parse_timestamps(spark, sf_dir):
    ev = feeds.events(spark, sf_dir)
    txt = F.when(F.col("event_type") == "error", F.concat(F.lit("bad-"), F.col("event_id").cast("string"))) \
        .otherwise(raw_timestamp_text("ts"))
    t = ev.select("event_id", txt.alias("ts_text")).withColumn("ts_parsed", parse_raw_timestamp("ts_text"))
    return t.select("event_id", "ts_text", "ts_parsed", format_timestamp("ts_parsed").alias("ts_formatted"),
                    F.to_date("ts_parsed").alias("ts_date"))


@register("parse_dates")
def q_parse_dates(spark, sf_dir):
    o = feeds.table(spark, sf_dir, "orders")
    txt = F.when(F.col("o_orderstatus") == "P",
                 F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-13-"), F.date_format("o_orderdate", "dd"))) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", txt.alias("date_text")).withColumn("parsed_date", parse_date("date_text"))


# --- quality ---------------------------------------------------------------------

def _event_rules():
    return [quality.has_size(), quality.is_complete("event_id"), quality.is_complete("user_id"),
            quality.is_complete("event_type")]


def _events_planted(spark, sf_dir):
    return feeds.events(spark, sf_dir).withColumn("event_type", F.expr("nullif(event_type, 'error')"))


@register("dq_checks")
def q_dq_checks(spark, sf_dir):
    return quality.run_checks(_events_planted(spark, sf_dir), _event_rules())


@register("dq_incremental")
def q_dq_incremental(spark, sf_dir):
    """The checks of all days, and of the first ten, from the states of daily
    files added in three batches; the third delivers every fifth day again,
    whose first delivery lacked some users. No file is read again."""
    day = F.to_date("ts")
    rows = _events_planted(spark, sf_dir).withColumn("file_date", day).withColumn("file_name", file_name_for(day))
    states = CheckStates(spark, scratch_path(spark, "states"), ["event_id", "user_id", "event_type"])
    short = (F.dayofmonth("ts") % 5 == 0) & (F.col("user_id") % 3 == 0)
    states.add(rows.where(~short & (F.dayofmonth("ts") <= 15)))
    states.add(rows.where(~short & (F.dayofmonth("ts") > 15)))
    states.add(rows.where(F.dayofmonth("ts") % 5 == 0))
    return states.run_checks(_event_rules()).withColumn("days", F.lit("all")).unionByName(
        states.run_checks(_event_rules(), last=_split_day(spark, sf_dir)).withColumn("days", F.lit("first ten")))


@register("schema_drift")
def q_schema_drift(spark, sf_dir):
    """Raw event lines with planted drift by day: a new field, a number as
    text, a field gone, keys as text on clicks, and lines cut off on errors."""
    src = scratch_path(spark, "events-lines")
    d = F.dayofmonth("ts") % 7
    click, error = F.col("event_type") == "click", F.col("event_type") == "error"
    user = F.col("user_id").cast("string")
    user = F.when((d == 3) & click, F.concat(F.lit('"'), user, F.lit('"'))).otherwise(user)
    quoted = lambda c: F.concat(F.lit('"'), F.regexp_replace(c, '"', '\\\\"'), F.lit('"'))
    profile = F.concat(F.lit('{"user_id":'), user, F.lit(',"event_type":'), quoted("event_type"),
                       F.when(d == 2, F.lit("")).otherwise(F.concat(F.lit(',"props":'), quoted("props"))), F.lit("}"))
    value = F.coalesce(F.col("value").cast("decimal(18,4)").cast("string"), F.lit("null"))
    value = F.when(d == 1, F.concat(F.lit('"'), value, F.lit('"'))).otherwise(value)
    line = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"ts":"'), raw_timestamp_text("ts"), F.lit('","value":'), value,
                    F.when(d == 0, F.lit(',"channel":"web"')).otherwise(F.lit("")), F.lit(',"profile":'), profile, F.lit("}"))
    line = F.when((d == 4) & error, F.substring(line, 1, 30)).otherwise(line)
    lines = feeds.events(spark, sf_dir).select(line.alias("value"), F.to_date("ts").alias("file_date"))
    lines.hint("rebalance", "file_date").write.partitionBy("file_date").text(src)
    return drift.drift(spark, spark.read.text(src), E_NESTED_SCHEMA, ["file_date"])


def _address_feed(spark, sf_dir) -> DataFrame:
    """Daily profiles with a nested address: the city follows the state but for every tenth user, the postcode is one of five."""
    n = F.regexp_extract("props", r"(\d+)", 1).cast("long")
    city = F.when(F.col("user_id") % 10 == 0, F.lit("x")).otherwise(F.concat("event_type", F.lit("-"), (n % 3).cast("string")))
    return _daily(spark, sf_dir).select(
        E_KEY, E_DAY, F.col("event_type").alias("customer_state"), city.alias("customer_city"),
        F.concat(city, F.lit("/"), (n % 7).cast("string")).alias("customer_address"), (n % 5).cast("string").alias("customer_zip"),
        F.when(n % 11 > 5, F.lit("Gold")).otherwise(F.lit("Silver")).alias("customer_tier"))


@register("change_levels")
def q_change_levels(spark, sf_dir):
    """Level and violations of every change of a history with a nested address."""
    tracked = [*changes.ADDRESS_ORDER, "customer_tier"]
    versions = scd2.build(_address_feed(spark, sf_dir), E_KEY, E_DAY, tracked)
    return changes.change_levels(versions, E_KEY, changes.ADDRESS_ORDER, ["customer_tier"])


@register("dq_gate")
def q_dq_gate(spark, sf_dir):
    ev = feeds.events(spark, sf_dir)
    quality.gate(ev, quality.default_rules("event_id", "user_id"), on_fail="raise")
    return ev.select(*EVENT_COLS)


@register("dq_gate_failing")
def q_dq_gate_failing(spark, sf_dir):
    """What the gate says of two suites: one passes, one fails (NULL event types) and leaves its input pending."""
    told = []
    for suite, rows, rules in (("plain", feeds.events(spark, sf_dir), quality.default_rules("event_id", "user_id")),
                               ("planted", _events_planted(spark, sf_dir), _event_rules())):
        ok, results = quality.gate(rows, rules, on_fail="skip")
        told += [(suite, ok, r["rule"], r["status"]) for r in results]
    return spark.createDataFrame(told, "suite string, passed boolean, rule string, status string")


@register("null_counts")
def q_null_counts(spark, sf_dir):
    return quality.null_counts(_events_planted(spark, sf_dir).select(*EVENT_COLS))


@register("column_conformance")
def q_column_conformance(spark, sf_dir):
    return quality.column_conformance(feeds.events(spark, sf_dir), {
        "event_id": "bigint", "value": "double", "event_type": "bigint", "props": "double", "user_id": "int"})


def _planted_amount() -> Column:
    """Amount text from `customer.c_acctbal` with planted faults: missing, 'nan'."""
    return (F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None).cast("string"))
            .when(F.col("c_mktsegment") == "MACHINERY", F.lit("nan"))
            .otherwise(F.format_string("%.2f", F.col("c_acctbal"))))


@register("amount_classes")
def q_amount_classes(spark, sf_dir):
    c = feeds.table(spark, sf_dir, "customer")
    return quality.amount_classes(c.select(_planted_amount().alias("amount")), "amount")


@register("quarantine_split")
def q_quarantine_split(spark, sf_dir):
    """Rows whose amount is missing, not a number, zero or negative go to
    quarantine with the fault as reason; the rest are good (§2.17)."""
    c = feeds.table(spark, sf_dir, "customer")
    facts = c.select("c_custkey", _planted_amount().alias("amount")).withColumn("reason", amount_class("amount"))
    good, bad = quality.quarantine_split(facts, F.col("reason") != "positive")
    return (good.select("c_custkey", "amount", F.lit("good").alias("side"), F.lit(None).cast("string").alias("reason"))
            .unionByName(bad.select("c_custkey", "amount", F.lit("quarantine").alias("side"), "reason")))


# --- streaming -------------------------------------------------------------------

@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    from chronoset.streaming import ingest

    src = _write_events_daily_json(spark, sf_dir)
    out = ingest.ingest_files(spark, src, E_NESTED_SCHEMA, scratch_path(spark, "stream-out"),
                              scratch_path(spark, "stream-ckpt"))
    return out.select("event_id", "ts", "profile.user_id", "profile.event_type", "value", "profile.props")


@register("stream_ingest_dedup")
def q_stream_ingest_dedup(spark, sf_dir):
    """Every day's rows delivered twice under other names, half of them in the
    same run and half in a later one: each row is in the sink once."""
    from chronoset.streaming import ingest

    src, out, ck = (scratch_path(spark, n) for n in ("stream-src", "stream-out", "stream-ckpt"))
    raw = _nested_events(spark, sf_dir)
    early = F.dayofmonth("ts") <= 15
    writers.write_daily_json(raw.where(early), src, "file_date")
    writers.write_daily_json(raw.where(early & (F.col("event_id") % 2 == 0)), src, "file_date", "append")
    ingest.ingest_files(spark, src, E_NESTED_SCHEMA, out, ck, once=("event_id", "ts", "60 days"))
    writers.write_daily_json(raw.where(~early | (F.col("event_id") % 2 == 1)), src, "file_date", "append")
    sink = ingest.ingest_files(spark, src, E_NESTED_SCHEMA, out, ck, once=("event_id", "ts", "60 days"))
    return sink.select("event_id", "ts", "profile.user_id", "profile.event_type", "value", "profile.props")


@register("stream_archive")
def q_stream_archive(spark, sf_dir):
    """Two drains with an archive: the first moves its files at the start of
    the second. Rows of the sink, and rows in files below the archive."""
    from pyspark.sql.types import _parse_datatype_string

    from chronoset.streaming import ingest

    src, out, ck, kept = (scratch_path(spark, n) for n in ("stream-src", "stream-out", "stream-ckpt", "archive"))
    raw = _nested_events(spark, sf_dir)
    writers.write_daily_json(raw.where(F.dayofmonth("ts") <= 15), src, "file_date")
    ingest.ingest_files(spark, src, E_NESTED_SCHEMA, out, ck, archive_dir=kept)
    writers.write_daily_json(raw.where(F.dayofmonth("ts") > 15), src, "file_date", "append")
    sink = ingest.ingest_files(spark, src, E_NESTED_SCHEMA, out, ck, archive_dir=kept)
    # the archive keeps each file's former path; the last batch's files still lie in the source
    schema = _parse_datatype_string(E_NESTED_SCHEMA)
    read = lambda where: json_scan.read_json(spark, where, schema, with_file=False, corrupt=False, options={"recursiveFileLookup": "true"})
    flat = lambda df, place: df.select("event_id", "ts", "profile.user_id", "profile.event_type", "value", "profile.props", F.lit(place).alias("place"))
    return flat(sink, "sink").unionByName(flat(read(kept), "archive"))


def _e_feed():
    from chronoset.jobs import FeedConfig

    return FeedConfig(schema=E_NESTED_SCHEMA, key=E_KEY, struct_name="profile", ts_col="ts", id_col="event_id",
                      attrs=E_ATTRS, tracked=E_TRACKED, fact_cols=["event_id", "ts", "value"])


@register("batch_load_history")
def q_batch_load_history(spark, sf_dir):
    """Two daily batch runs over the events' daily files: the first sees the
    files of days 1-15, the second all files and processes only the pending
    rest; the resulting dimension equals the full build."""
    from chronoset import jobs

    src = _write_events_daily_json(spark, sf_dir)
    base = scratch_path(spark, "batch")
    manifest = files.manifest(spark, src)
    jobs.run_batch(spark, manifest.where(F.dayofmonth("file_date") <= 15), _e_feed(), base, batch_id=2)
    jobs.run_batch(spark, manifest, _e_feed(), base, batch_id=1)
    return jobs.read_dimension(spark, base).select(E_KEY, *E_ATTRS, *scd2.BOOK_COLS)


@register("batch_load_facts")
def q_batch_load_facts(spark, sf_dir):
    """Files that also carry rows of the day before (each file holds the rows
    from 06:00 to 06:00), loaded by two batches: every event is a fact once."""
    from chronoset import jobs

    src, base = scratch_path(spark, "events-json"), scratch_path(spark, "batch")
    shifted = _nested_events(spark, sf_dir).withColumn("file_date", F.to_date(F.col("ts") + F.expr("interval 18 hours")))
    writers.write_daily_json(shifted, src, "file_date")
    manifest = files.manifest(spark, src)
    feed = _e_feed()
    feed.fact_cols = ["event_id", "ts", "value"]
    jobs.run_batch(spark, manifest.where(F.dayofmonth("file_date") <= 15), feed, base, batch_id=20240115)
    jobs.run_batch(spark, manifest, feed, base, batch_id=20240101)
    return jobs.read_facts(spark, base).select("event_id", "ts", "value", E_KEY, "fact_date")


def _deliver(spark, rows: DataFrame, root: str) -> None:
    """Daily files under fixed names, `file_date=<day>/transactions_<day>.json`; a file there before is replaced."""
    made = scratch_path(spark, "delivery")
    writers.write_daily_json(rows, made, "file_date")
    for folder in writers.list_dirs(spark, made):
        writers.delete_path(spark, f"{root}/{folder}")
        day = folder.split("=", 1)[1]
        for i, name in enumerate(sorted(writers.list_files(spark, f"{made}/{folder}"))):
            writers.move_path(spark, f"{made}/{folder}/{name}", f"{root}/{folder}/transactions_{day}{f'_{i}' if i else ''}.json")


def _corrected(raw: DataFrame) -> DataFrame:
    """Second delivery of the files of every fifth day: some users gone, others with other profiles."""
    p = F.col("profile")
    kind = F.when(p["user_id"] % 3 == 1, F.concat(p["event_type"], F.lit("-corrected"))).otherwise(p["event_type"])
    again = raw.where((F.dayofmonth("file_date") % 5 == 0) & (p["user_id"] % 3 != 0))
    return again.withColumn("profile", F.struct(p["user_id"].alias("user_id"), kind.alias("event_type"), p["props"].alias("props")))


@register("stream_redelivery")
def q_stream_redelivery(spark, sf_dir):
    """The streaming job over all files, then again, with a new checkpoint,
    after every fifth day's file was corrected under its name: the dimension
    is that of the last deliveries, and what they no longer say is gone."""
    from chronoset import jobs

    src, base = scratch_path(spark, "events-json"), scratch_path(spark, "stream")
    raw = _nested_events(spark, sf_dir)
    _deliver(spark, raw, src)
    jobs.run_stream(spark, src, _e_feed(), base, scratch_path(spark, "ckpt"))
    _deliver(spark, _corrected(raw), src)
    jobs.run_stream(spark, src, _e_feed(), base, scratch_path(spark, "ckpt"))
    return jobs.read_dimension(spark, base).select(E_KEY, *E_ATTRS, *scd2.BOOK_COLS)


@register("batch_redelivery")
def q_batch_redelivery(spark, sf_dir):
    """Facts after a batch run, corrections under the same names and a second
    run, which takes the changed files only."""
    from chronoset import jobs

    src, base = scratch_path(spark, "events-json"), scratch_path(spark, "batch")
    raw = _nested_events(spark, sf_dir)
    _deliver(spark, raw, src)
    jobs.run_batch(spark, files.manifest(spark, src), _e_feed(), base, batch_id=1)
    _deliver(spark, _corrected(raw), src)
    jobs.run_batch(spark, files.manifest(spark, src), _e_feed(), base, batch_id=2)
    return jobs.read_facts(spark, base).select("event_id", "ts", "value", E_KEY, "fact_date")


@register("ledger_changed")
def q_ledger_changed(spark, sf_dir):
    """State of every daily file against the ledger: days up to the 20th are
    done, then every fifth day is corrected, the 3rd vanishes, later days come."""
    src = scratch_path(spark, "events-json")
    raw = _nested_events(spark, sf_dir)
    day = F.dayofmonth("file_date")
    _deliver(spark, raw.where(day <= 20), src)
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    named = lambda: files.manifest(spark, src).withColumnRenamed("path", "file_name")
    ledger.record(named().withColumn("rows", F.lit(None).cast("long")), batch_id=1, token="batch~1")
    _deliver(spark, _corrected(raw).where(day <= 20).unionByName(raw.where(day > 20)), src)
    for folder in writers.list_dirs(spark, src):
        if folder.endswith("-03"):
            writers.delete_path(spark, f"{src}/{folder}")
    return ledger.compare(named()).select("file_date", "state")


@register("run_stream_history")
def q_run_stream_history(spark, sf_dir):
    """The streaming job in two runs, the second with a new checkpoint, whose
    batch numbers start again and which delivers all files again."""
    from chronoset import jobs

    src, base = scratch_path(spark, "events-json"), scratch_path(spark, "stream")
    raw = _nested_events(spark, sf_dir)
    writers.write_daily_json(raw.where(F.dayofmonth("ts") <= 15), src, "file_date")
    jobs.run_stream(spark, src, _e_feed(), base, scratch_path(spark, "ckpt"))
    writers.write_daily_json(raw.where(F.dayofmonth("ts") > 15), src, "file_date", "append")
    jobs.run_stream(spark, src, _e_feed(), base, scratch_path(spark, "ckpt"))
    return jobs.read_dimension(spark, base).select(E_KEY, *E_ATTRS, *scd2.BOOK_COLS)


@register("stream_quarantine")
def q_stream_quarantine(spark, sf_dir):
    """Events with planted faults through the streaming job: lines of errors
    are cut off, clicks lose their key. Good rows are facts, the others are in
    the quarantine with their reason, and no version has a NULL key."""
    from chronoset import jobs

    src, base = scratch_path(spark, "events-json"), scratch_path(spark, "stream")
    ev = feeds.events(spark, sf_dir)
    no_key = F.when(F.col("event_type") != "click", F.col("user_id"))
    line = F.to_json(F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "value",
                              F.struct(no_key.alias("user_id"), "event_type", "props").alias("profile")))
    line = F.when(F.col("event_type") == "error", F.substring(line, 1, 20)).otherwise(line)
    ev.select(line.alias("value"), F.to_date("ts").alias("file_date")).hint("rebalance", "file_date").write.partitionBy("file_date").text(src)
    jobs.run_stream(spark, src, _e_feed(), base, scratch_path(spark, "ckpt"))
    good = jobs.read_facts(spark, base).groupBy().agg(F.count(F.lit(1)).alias("n"))
    bad = jobs.read_quarantine(spark, base).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    dim = jobs.read_dimension(spark, base)
    keyless = dim.groupBy().agg(F.count_if(F.col(E_KEY).isNull() | F.col(START_COL).isNull()).alias("n"))
    return (good.select(F.lit("fact").alias("place"), "n").unionByName(bad.select(F.col("reason").alias("place"), "n"))
            .unionByName(keyless.select(F.lit("version without key or start").alias("place"), "n")))


@register("batch_load_transactions")
def q_batch_load_transactions(spark, sf_dir):
    """Orders with their customer in the raw transaction layout, through the
    batch job: typed facts with their decimal amount and date; urgent orders
    have a malformed timestamp and are not among them."""
    from chronoset import jobs

    src, base = scratch_path(spark, "orders-json"), scratch_path(spark, "batch")
    o = feeds.orders_nested(spark, sf_dir)
    c = F.col("customer_info")
    ts = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("not a time")).otherwise(raw_timestamp_text("o_orderdate"))
    profile = F.struct(c["c_custkey"].cast("string").alias("customer_id"), c["c_name"].alias("customer_name"),
                       c["c_mktsegment"].alias("customer_tier"), c["c_nationkey"].cast("string").alias("customer_state"))
    raw = o.select(F.col("o_orderkey").cast("string").alias("transaction_id"), ts.alias("transaction_timestamp"),
                   F.format_string("%.2f", "o_totalprice").alias("amount"), F.col("o_orderstatus").alias("transaction_status"),
                   profile.alias("customer_info"), F.trunc("o_orderdate", "year").alias("file_date"))
    writers.write_daily_json(raw, src, "file_date")
    manifest = files.manifest(spark, src)
    jobs.run_batch(spark, manifest, jobs.transaction_feed(), base, batch_id=1, on_fail="quarantine")
    facts = jobs.read_facts(spark, base)
    return facts.select("transaction_id", "transaction_timestamp", "transaction_date", "amount", F.col("amount_num").cast("double").alias("amount_num"),
                        "transaction_status", "customer_id")


@register("stream_scd2_state")
def q_stream_scd2_state(spark, sf_dir):
    """The history with the open version as stream state, in three runs: the
    days to the 15th, the later ones, and then rows of some users' early days
    that come late, whose users are rebuilt from all rows."""
    from chronoset.streaming.open_state import OpenState

    src, out, ck = (scratch_path(spark, n) for n in ("stream-src", "stream-out", "stream-ckpt"))
    raw = _nested_events(spark, sf_dir)
    late = (F.col("profile.user_id") % 10 == 0) & (F.dayofmonth("ts") <= 10)
    state = OpenState(E_KEY, E_ATTRS, E_TRACKED, ["ts", "event_id"])
    for part in (~late & (F.dayofmonth("ts") <= 15), F.dayofmonth("ts") > 15, late):
        writers.write_daily_json(raw.where(part), src, "file_date", "append")
        state.drain(spark, src, E_NESTED_SCHEMA, "profile", out, ck)
    return state.history(spark, out, feeds.events(spark, sf_dir)).select(E_KEY, *E_ATTRS, *scd2.BOOK_COLS)


@register("stream_scd2")
def q_stream_scd2(spark, sf_dir):
    from chronoset.streaming import history

    src = _write_events_daily_json(spark, sf_dir)
    kept = history.run_history_stream(spark, src, E_NESTED_SCHEMA, scratch_path(spark, "stream-dim"),
                                      scratch_path(spark, "stream-ckpt"), max_files_per_trigger=7)
    return kept.read().select(E_KEY, *E_ATTRS, *scd2.BOOK_COLS)

