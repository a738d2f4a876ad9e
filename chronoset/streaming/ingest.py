"""Incremental file ingestion with Structured Streaming.

The file source keeps the set of processed files in its checkpoint, which
replaces "files still in the raw bucket" as the pending state; with
`trigger(availableNow=True)` one run drains whatever is pending and stops,
the streaming form of an event-triggered batch. `cleanSource=archive` moves
processed files to an archive folder (the move lags one batch: the
checkpoint, not the folder, is the truth).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoset.schemas import TS_NTZ_FORMAT, with_corrupt_column
from chronoset.sources.json_scan import CORRUPT


def file_stream(spark: SparkSession, source_dir: str, schema, fmt: str = "json",
                max_files_per_trigger: int | None = None, archive_dir: str | None = None,
                corrupt: bool = False) -> DataFrame:
    """The files of `source_dir` as a stream; with `corrupt`, unparsable lines keep their text in a column."""
    if corrupt:
        schema = with_corrupt_column(T._parse_datatype_string(schema) if isinstance(schema, str) else schema, CORRUPT)
    reader = spark.readStream.schema(schema).format(fmt).option("timestampNTZFormat", TS_NTZ_FORMAT)
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(source_dir)


def drained(query, timeout_s: int | None = None) -> None:
    """Wait until an `availableNow` query has read all that was pending; without `timeout_s` as long as it takes."""
    if timeout_s is None:
        query.awaitTermination()
    else:
        query.awaitTermination(timeout_s)
        if query.isActive:
            query.stop()
            raise TimeoutError("the stream did not drain in time")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave to the query of this checkpoint; a new checkpoint has a new one."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"]


def ingest_files(spark: SparkSession, source_dir: str, schema, sink_path: str, checkpoint: str,
                 fmt: str = "json", archive_dir: str | None = None, max_files_per_trigger: int | None = None,
                 timeout_s: int | None = None, once: tuple[str, str, str] | None = None) -> DataFrame:
    """Drain pending files into an append-only parquet sink; return the sink's good rows.

    Exactly-once into the file sink: the sink's own log records committed
    batches, so a restarted run neither loses nor duplicates rows. Lines that
    do not parse are kept apart, in a folder of the sink (`broken_lines`).

    `once=(id, timestamp, horizon)` takes a row once however many files bring
    it: ids seen within the horizon before the latest timestamp are kept as
    state (`dropDuplicatesWithinWatermark`). A row later than the horizon is
    not taken, as it can't be told from one taken before: choose a horizon
    beyond the feed's latest delivery. Rows without id or timestamp are kept
    apart with the broken lines.
    """
    stream = file_stream(spark, source_dir, schema, fmt, max_files_per_trigger, archive_dir, corrupt=fmt == "json")
    broken = F.col(CORRUPT).isNotNull() if fmt == "json" else F.lit(False)
    if once:
        row_id, ts, horizon = once
        unfit = broken | F.col(row_id).isNull() | F.col(ts).isNull()
        # only rows with a timestamp may move the watermark or be late
        fit = stream.where(~unfit).withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", horizon)
        fit = fit.dropDuplicatesWithinWatermark([row_id]).drop("_at").withColumn("_broken", F.lit(False))
        out = fit.unionByName(stream.where(unfit).withColumn("_broken", F.lit(True)))
    else:
        out = stream.withColumn("_broken", broken)
    drained(out.writeStream.format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint)
            .partitionBy("_broken").outputMode("append").trigger(availableNow=True).start(), timeout_s)
    return spark.read.parquet(sink_path).where("not _broken").drop("_broken", CORRUPT)


def broken_lines(spark: SparkSession, sink_path: str) -> DataFrame:
    """The rows a sink kept apart, as their line; read from their own folder, nothing is copied."""
    bad = spark.read.parquet(sink_path).where(F.col("_broken").cast("boolean"))
    line = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*[c for c in bad.columns if c not in (CORRUPT, "_broken")])))
    return bad.select(line.alias("line"), F.when(F.col(CORRUPT).isNotNull(), "broken line").otherwise("missing id or timestamp").alias("reason"))
