"""End-to-end runs: the daily batch (O1), the incremental stream (O2), catch-up (O3).

All share one batch of steps, made safe to repeat:

1. the batch's files are fixed: by an intent table, written before anything
   else (batch), or by the stream's checkpoint. A batch takes the listed files
   that are new, and those whose length or modification time differ from what
   was loaded: a corrected file is loaded again;
2. the rows are parsed once and staged with the reason, if any, why a row
   cannot be used (broken line, missing id, key or timestamp);
3. the quality gate reads two staged columns and raises, skips, or, with
   `on_fail="quarantine"`, judges the good rows only;
4. facts go to their dates' folders, in a part of the batch's own, bad rows to
   the quarantine, profiles into the history (which skips a batch it has
   committed, and takes back what a corrected file no longer says);
5. the ledger gets a row per file. It is the commit: facts count once their
   file's row is there, and of a file delivered again only the last delivery;
6. the files are archived, the staged rows and the intent removed.

A crash before step 5 leaves the intent, and the next run replays exactly its
files under the same batch number; every step before overwrites what it wrote.
A batch is known by run and number. Runs are "batch" or the id of a streaming
query, so batches and streams, old checkpoints and new, never meet.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chronoset import schemas
from chronoset.functions.scalar import amount_decimal, file_date, parse_raw_timestamp
from chronoset.operators import quality, scd2
from chronoset.sinks import writers
from chronoset.sinks.dimension import Dimension
from chronoset.sinks.ledger import PRINT, Ledger, next_number
from chronoset.sources import files, json_scan
from chronoset.streaming.history import FILE, HistoryStream
from chronoset.streaming.ingest import drained, file_stream, query_id

BATCH_RUN = "batch"
REASON = "_reason"
#: Rows up to which any day of a batch may be written by one task.
SMALL_BATCH = 1_000_000


@dataclass
class FeedConfig:
    """How a raw feed maps onto fact rows and profile snapshots."""

    schema: object                      # StructType or DDL string of the raw line
    key: str                            # business key inside the profile struct
    struct_name: str                    # embedded profile struct
    ts_col: str                         # event timestamp (TIMESTAMP_NTZ after `parse`)
    id_col: str                         # row id, tie-break of the daily latest
    attrs: list[str]                    # profile attributes kept in the dimension
    tracked: list[str]                  # attributes whose change opens a version
    fact_cols: list[str] = field(default_factory=list)
    mode: str = scd2.CHANGED_ONLY
    day: str = "day"
    fact_day: str = "fact_date"
    parse: Callable[[DataFrame], DataFrame] | None = None   # raw columns to typed ones
    file_date_share: float | None = None                    # least share of rows dated as their file
    buckets: int = 8                                        # of the dimension

    def checked(self, raw: DataFrame) -> DataFrame:
        """Typed rows with the reason why a row cannot be used, NULL for good rows."""
        rows = self.parse(raw) if self.parse else raw
        reason = F.when(F.col(json_scan.CORRUPT).isNotNull(), "broken line")
        reason = reason.when(F.col(self.id_col).isNull(), "missing id")
        reason = reason.when(F.col(f"{self.struct_name}.{self.key}").isNull(), "missing key")
        reason = reason.when(F.col(self.ts_col).isNull(), "missing or malformed timestamp")
        return rows.withColumn(REASON, reason)

    def flat_profiles(self, rows: DataFrame) -> DataFrame:
        return rows.select(
            F.col(f"{self.struct_name}.{self.key}").alias(self.key),
            F.to_date(self.ts_col).alias(self.day),
            F.col(self.ts_col), F.col(self.id_col),
            *[F.col(f"{self.struct_name}.{a}").alias(a) for a in self.attrs],
            F.col("file_name").alias(FILE),
        )

    def facts(self, rows: DataFrame) -> DataFrame:
        cols = self.fact_cols or [c for c in rows.columns if c not in (self.struct_name, "file_name", "file_date", *PRINT) and not c.startswith("_")]
        return rows.select(*cols, F.col(f"{self.struct_name}.{self.key}").alias(self.key),
                           F.to_date(self.ts_col).alias(self.fact_day), "file_name")

    def gate_view(self, rows: DataFrame) -> DataFrame:
        return rows.select(F.col(self.id_col), F.col(f"{self.struct_name}.{self.key}").alias(self.key),
                           F.to_date(self.ts_col).alias("__row_date"), F.col("file_date").alias("__file_date"))

    def rules(self) -> list[quality.Rule]:
        rules = quality.default_rules(self.id_col, self.key)
        if self.file_date_share is not None:
            rules.append(quality.dated_as_file("__row_date", "__file_date", self.file_date_share))
        return rules


def transaction_feed(**changes) -> FeedConfig:
    """The raw transaction files: text timestamps and amounts, customer profile embedded."""
    def typed(raw: DataFrame) -> DataFrame:
        return raw.withColumn("amount_num", amount_decimal(F.col("amount"))).withColumn(
            "transaction_timestamp", parse_raw_timestamp("transaction_timestamp"))

    cols = [c for c in schemas.FACT_COLUMNS if c not in ("transaction_date", schemas.CUSTOMER_KEY)]
    given = dict(schema=schemas.RAW_TRANSACTION_SCHEMA, key=schemas.CUSTOMER_KEY, struct_name="customer_info",
                 ts_col="transaction_timestamp", id_col="transaction_id", attrs=schemas.PROFILE_FIELDS[1:],
                 tracked=schemas.TRACKED_ATTRIBUTES, fact_cols=[*cols, "amount_num"], fact_day="transaction_date", parse=typed)
    return FeedConfig(**{**given, **changes})


class Layout:
    """Folders of one deployment, all below one base path."""

    def __init__(self, base: str):
        base = base.rstrip("/")
        self.fact, self.history, self.ledger = f"{base}/fact", f"{base}/history", f"{base}/_ledger"
        self.intents, self.stage, self.quarantine = f"{base}/_intents", f"{base}/_stage", f"{base}/quarantine"
        self.compaction = f"{base}/_compaction"


def _history(spark: SparkSession, lay: Layout, cfg: FeedConfig) -> HistoryStream:
    return HistoryStream(spark, lay.history, cfg.key, cfg.tracked, cfg.attrs, [cfg.ts_col, cfg.id_col], cfg.mode, cfg.day,
                         buckets=cfg.buckets)


def _process(spark: SparkSession, lay: Layout, cfg: FeedConfig, raw: DataFrame, listed: DataFrame | None, run: str,
             number: int, on_fail: str, label: int | None = None) -> dict:
    """Steps 2 to 5 for rows with file_name and file_date. `listed` names the batch's files, else those that have rows."""
    name = f"{run}~{number}"
    stage = f"{lay.stage}/{name}"
    if writers.path_exists(spark, stage):
        _drop_part(spark, lay, cfg, name)
    obs = Observation(f"stage-{name}")
    counted = cfg.checked(raw).observe(obs, F.count(F.lit(1)).alias("rows"), F.count(REASON).alias("bad"))
    counted.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(stage)
    staged, n_bad = obs.get.get("rows", 0), obs.get.get("bad", 0)
    rows = spark.read.parquet(stage)
    good = rows.where(F.col(REASON).isNull())
    lenient = on_fail == "quarantine"
    ok, results = quality.gate(cfg.gate_view(good if lenient else rows), cfg.rules(), "raise" if on_fail == "raise" else "skip")
    if not ok and not lenient:
        writers.delete_path(spark, stage)
        return {"status": "failed_checks", "checks": [r.asDict() for r in results]}
    bad = rows.where(F.col(REASON).isNotNull())
    kept = F.coalesce(F.col(json_scan.CORRUPT), F.to_json(F.struct(*[c for c in rows.columns if not c.startswith("_")])))
    if n_bad:
        (bad.select("file_name", "file_date", F.col(REASON).alias("reason"), kept.alias("line"))
         .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{lay.quarantine}/token={name}"))
    # a folder a date, in it a part a batch
    facts = cfg.facts(good).withColumn("token", F.lit(name)).withColumn("part", F.lit(name))
    # a hot day is split at run time; in a small batch no day is hot, and many small days keep all tasks busy
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    facts = facts.repartition(width, cfg.fact_day) if staged < SMALL_BATCH else facts.hint("rebalance", cfg.fact_day)
    fact_rows = writers.load_append(facts, lay.fact, [cfg.fact_day, "part"])
    prints = [c for c in PRINT if c in (rows if listed is None else listed).columns]
    given = (rows.select("file_name", "file_date", *prints) if listed is None else listed.select("file_name", "file_date", *prints)).distinct()
    hist = _history(spark, lay, cfg)
    hist.process(cfg.flat_profiles(good), number, run, given.select(F.col("file_name").alias(FILE)))
    per_file = given.join(good.groupBy("file_name").agg(F.count(F.lit(1)).alias("rows")), "file_name", "left")
    # only batch runs have a label
    Ledger(spark, lay.ledger).record(per_file, label, token=name)
    writers.delete_path(spark, stage)
    return {"status": "done", "fact_rows": fact_rows, "quarantined": n_bad, "dimension_version": hist.dimension.version()}


def _drop_part(spark: SparkSession, lay: Layout, cfg: FeedConfig, name: str) -> None:
    """Facts that an earlier attempt of this batch left: its staged rows are still there."""
    for day in writers.list_dirs(spark, lay.fact):
        writers.delete_path(spark, f"{lay.fact}/{day}/part={name}")


def _read_listed(spark: SparkSession, cfg: FeedConfig, listed: DataFrame) -> DataFrame:
    """Rows of the listed files, none of the days between.

    The feed's root is read, not a path list. Under dated folders it is joined
    to the dates of the list, which are broadcast (days of a calendar) and
    prune the folders at run time; files that carry their date in their names
    only are pruned by those dates at planning. Then the file names decide.
    """
    roots, nested = _roots(listed)
    raw = json_scan.read_json(spark, roots, json_scan.as_struct(cfg.schema), with_file=False,
                              options={"recursiveFileLookup": "true"} if nested else None)
    raw = raw.withColumn("file_name", F.col("_metadata.file_path"))
    dates = listed.select("file_date").distinct()
    if "file_date" in raw.columns:
        # "is at least the first" makes the list a selective side, which pruning at run time asks for
        first, undated = listed.agg(F.min("file_date"), F.count_if(F.col("file_date").isNull())).first()
        if first is not None and not undated:
            typed = dates.where(F.col("file_date") >= F.lit(first)).select(F.col("file_date").cast(raw.schema["file_date"].dataType).alias("file_date"))
            raw = raw.join(F.broadcast(typed), "file_date", "left_semi")
    else:
        days = [r[0] for r in dates.collect()]
        if None not in days:
            raw = raw.where(file_date(F.col("_metadata.file_name")).isin(days))
    return raw.drop("file_date").join(listed.select("file_name", "file_date"), "file_name")


def _file_date(rows: DataFrame) -> Column:
    """Date of the file a row comes from: that of its dated folder, a partition column, or else of its name."""
    named = file_date(F.col("_metadata.file_name"))
    return F.coalesce(F.col("file_date").cast("date"), named) if "file_date" in rows.columns else named


def _roots(listed: DataFrame) -> tuple[list[str], bool]:
    """Folders of the feeds, one for each feed, not for each day; and whether plain dated folders lie below them.

    Folders like `file_date=2025-01-01`, `2025-01-01` or `2025/01/01` belong to
    the files.
    """
    folder = F.regexp_replace(F.col("file_name"), r"(/([^/=]+=[^/]+|[0-9]{4}(-[0-9]{2}){0,2}|[0-9]{2}))*/[^/]+$", "")
    plain = F.regexp_extract(F.substring(F.col("file_name"), F.length(folder) + 1, 4096), r"^((/[0-9-]+)+)/[^/]+$", 1) != ""
    rows = listed.groupBy(folder.alias("f")).agg(F.max(plain).alias("nested")).collect()
    return [r["f"] for r in rows], any(r["nested"] for r in rows)


def run_batch(spark: SparkSession, manifest: DataFrame, cfg: FeedConfig, base: str, batch_id: int,
              on_fail: str = "raise", archive_dir: str | None = None) -> dict:
    """Process every manifest file that is new or changed since it was loaded, as one batch.

    `manifest` has `path` and `file_date` and, for changes to be seen, `length`
    and `modified`, as `files.manifest` gives them. Of a file that changed the
    last delivery counts: its facts and profiles replace the former ones.
    `batch_id` is a label, in any order: a label in the ledger is not run
    again. A batch that an earlier run left open is finished first. No row and
    no path list reaches the driver.
    """
    lay = Layout(base)
    ledger = Ledger(spark, lay.ledger)
    ledger.compact()
    listing = manifest.select(F.col("path").alias("file_name"), "file_date", *[c for c in PRINT if c in manifest.columns])
    for name in sorted(writers.list_dirs(spark, lay.intents)):
        if writers.path_exists(spark, f"{lay.intents}/{name}/_SUCCESS"):
            number = int(name.split("=", 1)[1])
            left = spark.read.parquet(f"{lay.intents}/{name}")
            _finish(spark, lay, cfg, left, number, on_fail, archive_dir)
    if ledger.seen_batch(batch_id):
        return {"status": "already_done", "files": 0}
    pending = ledger.pending(listing, "file_name")
    number = next_number(spark, lay.ledger, BATCH_RUN)
    intent = f"{lay.intents}/number={number}"
    n = writers.write_counted(pending.distinct().withColumn("label", F.lit(batch_id).cast("long")), intent, "overwrite",
                              options={"partitionOverwriteMode": "static"})
    if not n:
        writers.delete_path(spark, intent)
        return {"status": "nothing_pending", "files": 0}
    return _finish(spark, lay, cfg, spark.read.parquet(intent), number, on_fail, archive_dir) | {"files": n}


def _finish(spark: SparkSession, lay: Layout, cfg: FeedConfig, listed: DataFrame, number: int, on_fail: str,
            archive_dir: str | None) -> dict:
    """Run the batch that an intent describes and close the intent."""
    intent = f"{lay.intents}/number={number}"
    label = listed.agg(F.max("label")).first()[0]
    result = {"status": "done"}
    # a crash between ledger and clean-up left an intent whose batch is done
    if not Ledger(spark, lay.ledger).seen_token(f"{BATCH_RUN}~{number}"):
        raw = _read_listed(spark, cfg, listed)
        try:
            result = _process(spark, lay, cfg, raw, listed, BATCH_RUN, number, on_fail, label)
        except quality.CheckFailed:
            # a refused batch stays pending as files, not as an open batch
            writers.delete_path(spark, intent)
            raise
    if archive_dir and result["status"] == "done":
        files.archive(spark, listed.select("file_name"), archive_dir)
    writers.delete_path(spark, intent)
    return result


def read_dimension(spark: SparkSession, base: str) -> DataFrame | None:
    return Dimension(spark, f"{Layout(base).history}/dimension").read()


def _live_facts(spark: SparkSession, lay: Layout) -> DataFrame | None:
    _finish_compaction(spark, lay)
    if not [n for n in writers.list_dirs(spark, lay.fact) if "=" in n]:
        return None
    facts = spark.read.parquet(lay.fact)
    return facts.join(Ledger(spark, lay.ledger).live(), ["token", "file_name"], "left_semi")


def read_facts(spark: SparkSession, base: str) -> DataFrame | None:
    """Facts of committed batches; of a file delivered more than once, those of its last delivery.

    Facts lie in a folder a date: a filter on the date opens its folder only.
    """
    facts = _live_facts(spark, Layout(base))
    return None if facts is None else facts.drop("token", "part")


def compact_facts(spark: SparkSession, base: str, cfg: FeedConfig, first: _dt.date, last: _dt.date) -> int:
    """Gather the parts of every date from `first` to `last` into one and drop deliveries that no longer count.

    Maintenance, to be run while no batch and no reader runs. The gathered rows
    and the list of parts they replace are written aside first, so a run that
    is cut short is finished by the next one, or by the next reader.
    """
    lay = Layout(base)
    facts = _live_facts(spark, lay)
    if facts is None:
        return 0
    inside = facts.where(F.col(cfg.fact_day).between(F.lit(first), F.lit(last)))
    # a name of its own, so that finishing twice removes nothing new
    rows = inside.withColumn("part", F.lit(f"all~{uuid.uuid4().hex[:12]}"))
    n = writers.write_counted(rows.hint("rebalance", cfg.fact_day), f"{lay.compaction}/rows", "overwrite", [cfg.fact_day, "part"], options={"partitionOverwriteMode": "static"})
    days = [f"{first + _dt.timedelta(i)}" for i in range((last - first).days + 1)]
    old = [(f"{cfg.fact_day}={d}/{p}",) for d in days for p in writers.list_dirs(spark, f"{lay.fact}/{cfg.fact_day}={d}")]
    spark.createDataFrame(old, "folder string").coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{lay.compaction}/replaced")
    _finish_compaction(spark, lay)
    return n


def _finish_compaction(spark: SparkSession, lay: Layout) -> None:
    """Put gathered rows in the place of the parts they replace: remove those, then move the new ones in, each by a rename."""
    if not writers.path_exists(spark, f"{lay.compaction}/replaced/_SUCCESS"):
        return
    for r in spark.read.parquet(f"{lay.compaction}/replaced").collect():
        writers.delete_path(spark, f"{lay.fact}/{r['folder']}")
    for day in writers.list_dirs(spark, f"{lay.compaction}/rows"):
        for part in writers.list_dirs(spark, f"{lay.compaction}/rows/{day}"):
            writers.move_path(spark, f"{lay.compaction}/rows/{day}/{part}", f"{lay.fact}/{day}/{part}")
    writers.delete_path(spark, f"{lay.compaction}/replaced")
    writers.delete_path(spark, lay.compaction)


def read_quarantine(spark: SparkSession, base: str) -> DataFrame | None:
    """Rows that could not be used: file_name, file_date, reason, line."""
    lay = Layout(base)
    if not writers.list_dirs(spark, lay.quarantine):
        return None
    return spark.read.parquet(lay.quarantine).join(Ledger(spark, lay.ledger).live(), ["token", "file_name"], "left_semi").drop("token")


def run_stream(spark: SparkSession, source_dir: str, cfg: FeedConfig, base: str, checkpoint: str,
               max_files_per_trigger: int | None = None, timeout_s: int | None = None, on_fail: str = "quarantine",
               archive_dir: str | None = None) -> dict:
    """Drain pending files with Structured Streaming; the same steps per micro-batch.

    A micro-batch is known by the query's id and its number, so a replay is
    harmless and a new checkpoint starts a new run: files it delivers again
    replace what they delivered before, in the facts and in the history. Within
    a checkpoint the file source takes a path once; a file corrected under its
    name is picked up by a batch run on the same base. With `on_fail`
    "raise" a failing micro-batch stops the stream and is tried again by the
    next run; "skip" leaves its rows out, and its files out of the ledger.
    """
    lay = Layout(base)

    def per_batch(batch: DataFrame, number: int) -> None:
        run = query_id(spark, checkpoint)
        if not Ledger(spark, lay.ledger).seen_token(f"{run}~{number}"):
            _process(spark, lay, cfg, batch, None, run, number, on_fail)

    stream = file_stream(spark, source_dir, cfg.schema, "json", max_files_per_trigger, archive_dir, corrupt=True)
    stream = stream.withColumns({"file_name": F.col("_metadata.file_path"), "file_date": _file_date(stream),
                                 "length": F.col("_metadata.file_size"), "modified": F.col("_metadata.file_modification_time")})
    drained(stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(), timeout_s)
    return {"status": "done", "dimension_version": _history(spark, lay, cfg).dimension.version()}


def catch_up(spark: SparkSession, manifest: DataFrame, cfg: FeedConfig, base: str, batch_id: int, first_day: _dt.date,
             up_to: _dt.date, on_fail: str = "raise", archive_dir: str | None = None) -> tuple[dict, DataFrame]:
    """Load what has arrived since the last processed day and report the days still without a file (O3).

    Days are looked for from the day after the ledger's latest, or from
    `first_day` while nothing was ever processed, up to `up_to`.
    """
    latest = Ledger(spark, Layout(base).ledger).latest_date().first()[0]
    done = spark.createDataFrame([(latest,)], "latest_date date")
    # days of a calendar; looked for before the batch, which may move the listed files
    missing = files.missing_dates(done, manifest, up_to, first_day=first_day).collect()
    result = run_batch(spark, manifest, cfg, base, batch_id, on_fail, archive_dir)
    return result, spark.createDataFrame(missing, "file_date date")

