"""Processed-file ledger.

A file is done when the ledger has a row for it. The rows of a batch are
written in one go, after every other write of the batch succeeded, so a failed
batch leaves its files pending. The row's token names the batch that loaded
the file; of several rows of a file the last one counts. A row keeps the
file's fingerprint, its length and modification time, so a file delivered
again under its name is told from one that is done. (A rewrite of equal length
within the file system's clock tick can't be seen.)

A batch has a folder of its own, so a replay overwrites what it wrote, and
whether a batch is committed is answered by a listing. `compact` gathers the
folders into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoset.schemas import LEDGER_SCHEMA
from chronoset.sinks.writers import delete_path, list_dirs, path_exists

PRINT = ["length", "modified"]
NEW, CHANGED, DONE, VANISHED = "new", "changed", "done", "vanished"


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path).drop("part")

    def last(self) -> DataFrame:
        """The last row of each file that is done."""
        cols = [f.name for f in LEDGER_SCHEMA.fields if f.name != "file_name"]
        done = self.read().where(F.col("status") == "done")
        best = done.groupBy("file_name").agg(F.max_by(F.struct(*cols), "number").alias("r"))
        return best.select("file_name", "r.*")

    def compare(self, listing: DataFrame, name_col: str = "file_name") -> DataFrame:
        """Every file of the listing or the ledger with its state.

        `new`: not in the ledger; `changed`: length or modification time
        differ from those of its last delivery; `done`; `vanished`: no longer
        listed (moved to the archive, as a rule). One full outer join on the
        name. Without fingerprints on either side a known file is done.
        """
        prints = [c for c in PRINT if c in listing.columns]
        known = self.last().select(F.col("file_name").alias("__f"), F.col("file_date").alias("__d"), *[F.col(c).alias(f"__{c}") for c in PRINT])
        j = listing.withColumn("__here", F.lit(True)).join(known, F.col(name_col) == F.col("__f"), "full_outer")
        differs = F.lit(False)
        for c in prints:
            differs = differs | F.coalesce(F.col(c) != F.col(f"__{c}"), F.lit(False))
        state = F.when(F.col("__here").isNull(), VANISHED).when(F.col("__f").isNull(), NEW).when(differs, CHANGED).otherwise(DONE)
        filled = {name_col: "__f", "file_date": "__d"}
        cols = [F.coalesce(F.col(c), F.col(filled[c])).alias(c) if c in filled else F.col(c) for c in listing.columns]
        return j.select(*cols, state.alias("state"))

    def pending(self, listing: DataFrame, name_col: str = "file_name") -> DataFrame:
        """Listed files that are new or changed."""
        return self.compare(listing, name_col).where(F.col("state").isin(NEW, CHANGED)).drop("state")

    def record(self, files: DataFrame, batch_id: int | None, status: str = "done", token: str = "") -> None:
        """Write the ledger rows of a batch: file_name, file_date, rows and, where known, the fingerprint."""
        number = (self.read().agg(F.max("number")).first()[0] or 0) + 1
        prints = [F.col(c) if c in files.columns else F.lit(None).alias(c) for c in PRINT]
        out = files.select("file_name", "file_date", F.lit(batch_id).alias("batch_id"), "rows", F.lit(status).alias("status"), F.lit(token).alias("token"),
                           F.lit(number).alias("number"), *prints)
        out = out.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER_SCHEMA.fields])
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/part={token or f'n{number}'}")

    def seen_batch(self, batch_id: int) -> bool:
        """True when a batch of this label already committed."""
        return not self.read().where(F.col("batch_id") == batch_id).isEmpty()

    def seen_token(self, token: str) -> bool:
        """True when this very batch already committed (at-least-once replay guard)."""
        if path_exists(self.spark, f"{self.path}/part={token}/_SUCCESS"):
            return True
        compacted = [n for n in list_dirs(self.spark, self.path) if n.startswith("part=to-")]
        return bool(compacted) and not self.read().where(F.col("token") == token).isEmpty()

    def live(self) -> DataFrame:
        """file_name and token of the last committed delivery of each file."""
        return self.last().select("file_name", "token")

    def latest_date(self) -> DataFrame:
        return self.read().select(F.max("file_date").alias("latest_date"))

    def compact(self, least: int = 100) -> bool:
        """Gather `least` batch folders or more into one; no row is dropped.

        The new folder is written first and the others go after, so a crash
        leaves rows twice, which no reader minds: the last row of a file is
        the last row. One job at a time writes a ledger.
        """
        parts = list_dirs(self.spark, self.path)
        if len(parts) < least:
            return False
        number = self.read().agg(F.max("number")).first()[0]
        name = f"part=to-{number}"
        rows = self.read().distinct().hint("rebalance")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/{name}")
        for part in set(parts) - {name}:
            delete_path(self.spark, f"{self.path}/{part}")
        return True


def next_number(spark: SparkSession, path: str, run: str) -> int:
    """A batch number of `run` that no committed batch has."""
    number = F.substring_index("token", "~", -1).cast("long")
    last = Ledger(spark, path).read().where(F.substring_index("token", "~", 1) == run).agg(F.max(number)).first()[0]
    return (last or 0) + 1
