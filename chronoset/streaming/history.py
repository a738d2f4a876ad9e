"""Incremental type 2 history (W3): one dimension version per batch, from deliveries of files.

A batch holds rows of newly delivered files. Files come in any order, one day
may come in several files, and a file may come again with other contents. So
the state is kept by delivery:

* `snapshots/part=<n>/`: one row per file, key and day, as batch n delivered
  them, with the order columns;
* `deliveries/part=<n>/`: the files of batch n, those without a usable row too.

Of a file delivered more than once only the last delivery counts: its rows
replace the former ones, and a key that it no longer holds is *retracted*, that
is rebuilt from what other files say, or gone if none does.

A batch is folded in one of two ways:

* all files new, all days after every stored day (the usual case): only the
  open rows of the batch's keys can change. They are replayed with the batch;
  the other open rows are written on where they are, closed rows are neither
  read nor written;
* a late day or a file delivered again: the keys of the batch, and the keys the
  former deliveries held, are rebuilt from the snapshots that count; the other
  keys' rows are copied. That rewrites the dimension, once for the batch.

The dimension's pointer is the commit. It names the snapshot parts and the last
day folded in; a part that no pointer names is overwritten by the next batch,
and a batch that is committed is skipped when it comes again. The result equals a build over the last
deliveries, whatever the order and grouping of files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoset.operators import scd2
from chronoset.sinks import writers
from chronoset.sinks.dimension import Dimension
from chronoset.streaming.ingest import drained, file_stream, query_id

FILE, DELIVERY = "_file", "_delivery"
OVERWRITE = {"partitionOverwriteMode": "static"}


class HistoryStream:
    """The history of a feed below `base`. `compact_every` bounds the snapshot parts and the dimension's tables a reader opens."""

    def __init__(self, spark: SparkSession, base: str, key: str, tracked: list[str], attrs: list[str],
                 order_cols: list[str], mode: str = scd2.CHANGED_ONLY, day: str = "day", compact_every: int = 64, buckets: int = 8):
        self.spark, self.base = spark, base.rstrip("/")
        self.key, self.tracked, self.attrs, self.order, self.mode, self.day = key, tracked, attrs, order_cols, mode, day
        self.dimension = Dimension(spark, f"{self.base}/dimension", key, buckets, compact_every)
        self.compact_every = compact_every

    # --- batches ---------------------------------------------------------------

    def process(self, flat_batch: DataFrame, batch_id: int, run: str = "", files: DataFrame | None = None) -> None:
        """Fold one batch: key, day, order columns, attributes and, if rows come from files, `_file`.

        `files` (`_file`) lists the batch's files where some may have no row.
        Without files a batch is a delivery of its own. Rows without key or day
        have no place in a history.
        """
        st = self.dimension.state()
        if self._seen(run, batch_id, st):
            return
        if FILE not in flat_batch.columns:
            flat_batch = flat_batch.withColumn(FILE, F.lit(f"{run}~{batch_id}"))
        part = f"part={st['version'] + 1}"
        delivery = F.lit(st["version"] + 1).cast("long")
        listed = flat_batch.select(FILE) if files is None else files.select(FILE)
        # the batch's span rides along with the write of its snapshots
        obs = Observation(f"history_batch_{batch_id}")
        rows = self._daily(flat_batch.where(F.col(self.key).isNotNull() & F.col(self.day).isNotNull()), FILE)
        rows = rows.withColumn(DELIVERY, delivery).withColumn("bucket", self._bucket())
        seen = rows.observe(obs, F.count(F.lit(1)).alias("n"), F.min(self.day).alias("lo"), F.max(self.day).alias("hi"),
                            F.collect_set("bucket").alias("buckets"))
        self._put(seen, f"{self.base}/snapshots/{part}")
        told = listed.distinct().select(FILE, delivery.alias(DELIVERY), F.lit(run).alias("run"), F.lit(batch_id).cast("long").alias("number"))
        told.write.mode("overwrite").options(**OVERWRITE).parquet(f"{self.base}/deliveries/{part}")
        runs = st["runs"] or {}
        self._fold(part, rows.schema, obs.get, {**runs, run: max(batch_id, runs.get(run, batch_id))}, st)

    def _seen(self, run: str, number: int, st: dict) -> bool:
        """Committed before: a number up to the run's largest is looked up among the deliveries."""
        if number > (st["runs"] or {}).get(run, -1):
            return False
        return not self.deliveries(st["snapshots"]).where((F.col("run") == run) & (F.col("number") == number)).isEmpty()

    def _bucket(self):
        return F.pmod(F.hash(F.col(self.key)), F.lit(self.dimension.buckets))

    def _put(self, rows: DataFrame, path: str) -> None:
        rows.hint("rebalance", "bucket").write.mode("overwrite").options(**OVERWRITE).partitionBy("bucket").parquet(path)

    def _daily(self, rows: DataFrame, *by: str) -> DataFrame:
        """The latest row per key, day (and file): largest order columns, then the later delivery, then values."""
        late = [DELIVERY] if DELIVERY in rows.columns and FILE not in by else []
        packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate([*self.order, *late])], *[F.col(c) for c in self.attrs])
        best = rows.select(*by, self.key, self.day, packed.alias("__p")).groupBy(*by, self.key, self.day).agg(F.max("__p").alias("__p"))
        return best.select(*by, self.key, self.day, *[F.col(f"__p.o{i}").alias(c) for i, c in enumerate(self.order)], *[F.col(f"__p.{a}").alias(a) for a in self.attrs])

    # --- what counts -------------------------------------------------------------

    def _read(self, kind: str, parts: list[str], schema) -> DataFrame:
        """Rows of the named parts; a path list bounded by `compact_every`."""
        return self.spark.read.schema(schema).option("basePath", f"{self.base}/{kind}").parquet(*[f"{self.base}/{kind}/{p}" for p in parts]).drop("part")

    def deliveries(self, parts: list[str]) -> DataFrame:
        return self._read("deliveries", parts, f"{FILE} string, {DELIVERY} long, run string, number long")

    def _counting(self, raw: DataFrame, parts: list[str], corrected: bool) -> DataFrame:
        """Snapshot rows of every file's last delivery; no join until a file came twice."""
        if not corrected:
            return raw
        last = self.deliveries(parts).groupBy(FILE).agg(F.max(DELIVERY).alias(DELIVERY))
        return raw.join(last, [FILE, DELIVERY], "left_semi")

    def snapshots(self, keys: DataFrame | None = None, parts: list[str] | None = None, corrected: bool | None = None,
                  schema: T.StructType | None = None, buckets: list[int] | None = None) -> DataFrame:
        """One row per key and day over all that counts, of some keys (and their buckets) or of all."""
        if parts is None:
            st = self.dimension.state()
            parts, corrected = st["snapshots"], st["corrected"]
        raw = self._read("snapshots", parts, schema) if schema else self.spark.read.option("basePath", f"{self.base}/snapshots").parquet(
            *[f"{self.base}/snapshots/{p}" for p in parts])
        if buckets is not None:
            raw = raw.where(F.col("bucket").isin(buckets))
        if keys is not None:
            raw = raw.join(keys, self.key, "left_semi")
        return self._daily(self._counting(raw, parts, corrected)).select(self.key, self.day, *self.attrs)

    # --- folding -----------------------------------------------------------------

    def _fold(self, part: str, schema: T.StructType, span: dict, runs: dict, st: dict) -> None:
        before = list(st["snapshots"] or [])
        parts = [*before, part]
        batch = self._read("snapshots", [part], schema)
        days = [d for d in (st["max_day"], span.get("hi")) if d is not None]
        told = {"runs": runs, "max_day": max(days, default=None), "snapshots": parts, "corrected": bool(st["corrected"]), "state": st}
        former = None
        if before:
            again = self.deliveries(before).join(self.deliveries([part]).select(FILE), FILE, "left_semi")
            if not again.isEmpty():
                told["corrected"] = True
                former = self._read("snapshots", before, schema).join(again.select(FILE).distinct(), FILE, "left_semi")
        if former is None and not span.get("n"):
            # nothing to fold and nothing to take back
            return
        in_order = former is None and (st["max_day"] is None or span["lo"] > st["max_day"])
        flat = self._daily(batch).select(self.key, self.day, *self.attrs)
        if not st["version"]:
            self._commit(scd2.build_history(flat, self.key, self.day, self.tracked, self.mode, self.attrs), True, told, schema)
        elif in_order:
            rebuilt, untouched = scd2.extend_open_parts(self.dimension.read_current(st), self.dimension.aligned(flat), self.key, self.day, self.tracked, self.mode)
            self._commit([untouched, rebuilt], False, told, schema)
        else:
            touched = batch.select(self.key, "bucket")
            if former is not None:
                touched = touched.unionByName(former.select(self.key, "bucket"))
            touched = touched.distinct()
            buckets = sorted(r[0] for r in touched.select("bucket").distinct().collect())
            keys = touched.select(self.key)
            kept = self.snapshots(keys, parts, told["corrected"], schema, buckets)
            rebuilt = scd2.build_history(kept, self.key, self.day, self.tracked, self.mode, self.attrs)
            untouched = self.dimension.read().join(self.dimension.aligned(keys), self.key, "left_anti")
            self._commit([untouched, rebuilt], True, told, schema)

    def _commit(self, rows, replace: bool, told: dict, schema: T.StructType) -> None:
        parts = told["snapshots"]
        compact = len(parts) > self.compact_every
        if compact:
            told = told | self._compacted(told, schema)
        self.dimension.commit(rows, replace, **told)
        if compact:
            for kind in ("snapshots", "deliveries"):
                for name in set(writers.list_dirs(self.spark, f"{self.base}/{kind}")) - set(told["snapshots"]):
                    writers.delete_path(self.spark, f"{self.base}/{kind}/{name}")

    def _compacted(self, told: dict, schema: T.StructType) -> dict:
        """Snapshots of every file's last delivery as one part, and the record of deliveries as one."""
        parts = told["snapshots"]
        name = f"part=to-{parts[-1].split('=', 1)[1]}"
        self._put(self._counting(self._read("snapshots", parts, schema), parts, told["corrected"]), f"{self.base}/snapshots/{name}")
        self.deliveries(parts).write.mode("overwrite").options(**OVERWRITE).parquet(f"{self.base}/deliveries/{name}")
        return {"snapshots": [name], "corrected": False}


def run_history_stream(spark: SparkSession, source_dir: str, schema, base: str, checkpoint: str,
                       key: str = "user_id", tracked: list[str] | None = None, attrs: list[str] | None = None,
                       order_cols: list[str] | None = None, max_files_per_trigger: int | None = None,
                       timeout_s: int | None = None, compact_every: int = 64, buckets: int = 8) -> Dimension:
    """Drain the nested event files under `source_dir` into a versioned history.

    The flattening below matches the nested events layout
    (`profile.<key>`, `profile.<attrs>`, text `ts`). The file source takes a
    path once for each checkpoint; a new checkpoint delivers all files again.
    """
    tracked = tracked or ["event_type"]
    attrs = attrs or ["event_type", "props"]
    order_cols = order_cols or ["ts", "event_id"]
    hs = HistoryStream(spark, base, key, tracked, attrs, order_cols, compact_every=compact_every, buckets=buckets)
    stream = file_stream(spark, source_dir, schema, "json", max_files_per_trigger)
    flat = stream.select(
        F.col(f"profile.{key}").alias(key),
        F.to_date("ts").alias("day"),
        *[F.col(c) for c in order_cols],
        *[F.col(f"profile.{a}").alias(a) for a in attrs],
        F.col("_metadata.file_path").alias(FILE),
    )

    def fold(batch: DataFrame, batch_id: int) -> None:
        hs.process(batch, batch_id, query_id(spark, checkpoint))

    drained(flat.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(), timeout_s)
    return hs.dimension
