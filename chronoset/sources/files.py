"""File discovery as DataFrames.

A listing is a DataFrame of paths: built by Spark's `binaryFile` source with
the content column pruned (only metadata is read), so discovering pending
files is itself a distributed job and never a driver loop over objects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoset.functions.scalar import base_name, date_list, file_date, file_date_text
from chronoset.schemas import FILE_NAME_PATTERN


def list_files(spark: SparkSession, directory: str, glob: str | None = None, recursive: bool = False,
               prefix: str | None = None, full_path: bool = True) -> DataFrame:
    """Listing of a folder: path, file_name, length, modification time.

    `prefix` keeps names that start with it; partition folders such as
    `file_date=2025-01-01/` appear as typed columns.
    """
    reader = spark.read.format("binaryFile")
    if recursive:
        # plain nested folders; `k=v` partition folders are discovered without it
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # the path as JSON scans report it too, so that listings and rows can be joined
    df = reader.load(directory).drop("content").withColumn("path", F.col("_metadata.file_path"))
    df = df.withColumn("file_name", base_name(F.col("path")))
    if prefix:
        df = df.where(F.col("file_name").startswith(prefix))
    if not full_path:
        df = df.withColumn("path", F.col("file_name"))
    return df


def file_dates(listing: DataFrame, name_col: str = "file_name", pattern: str = FILE_NAME_PATTERN) -> DataFrame:
    """Names whose text contains the dated file pattern, with the date.

    The search is unanchored, like `re.search`: `sub/x_2025-01-01.json.bak`
    style names match too. Ordered by date, since a listing has no order.
    """
    txt = file_date_text(F.col(name_col), pattern)
    return (
        listing.withColumn("__d", txt)
        .where(F.col("__d") != "")
        .select(F.col(name_col).alias("file_name"), F.col("__d").cast("date").alias("file_date"))
        .orderBy("file_date", "file_name")
    )


def latest_date(listing: DataFrame, name_col: str = "file_name", pattern: str = FILE_NAME_PATTERN) -> DataFrame:
    """Maximum date found in the names (A4); NULL on an empty listing."""
    return listing.select(F.max(file_date(F.col(name_col), pattern)).alias("latest_date"))


def date_spine(bounds: DataFrame, start: str = "start", end: str = "end", name: str = "file_date") -> DataFrame:
    """Every date from `start` to `end` inclusive for each bounds row."""
    return bounds.select(F.explode(date_list(F.col(start), F.col(end))).alias(name))


def missing_dates(latest: DataFrame, present: DataFrame, up_to, date_col: str = "file_date",
                  latest_col: str = "latest_date", first_day=None) -> DataFrame:
    """Days after the latest processed one, up to `up_to`, with no file (O3).

    `up_to` is a date (injected; never the wall clock inside the plan). While
    nothing was ever processed (NULL latest) the days start at `first_day`;
    without one that is an error, not an empty answer.
    """
    start = F.date_add(F.col(latest_col), 1)
    if first_day is not None:
        start = F.coalesce(start, F.lit(first_day).cast("date"))
    else:
        start = F.coalesce(start, F.raise_error(F.lit("nothing was processed yet: give first_day")).cast("date"))
    bounds = latest.select(start.alias("start"), F.lit(up_to).cast("date").alias("end"))
    return date_spine(bounds, name=date_col).join(present.select(date_col).distinct(), date_col, "left_anti")


def manifest(spark: SparkSession, directory: str, glob: str | None = "*.json", recursive: bool = False) -> DataFrame:
    """The listing a batch job takes: path, file_date, and the fingerprint length and modified.

    The date is that of the file's dated folder, else of its name.
    """
    listing = list_files(spark, directory, glob, recursive)
    named = file_date(F.col("file_name"))
    day = F.coalesce(F.col("file_date").cast("date"), named) if "file_date" in listing.columns else named
    return listing.select("path", day.alias("file_date"), "length", F.col("modificationTime").alias("modified"))


def archive(spark: SparkSession, listed: DataFrame, archive_dir: str) -> int:
    """Move processed files below `archive_dir`, their dated folders kept (K7); the number moved.

    The list is dealt out and every task moves its files. A file that is no
    longer there has been moved before, so a task that is tried again, or a
    batch that is replayed, does no harm. Tasks move files of the stores that
    pyarrow can open (local, HDFS, S3, GCS); names of other stores come back
    to the driver, one move each.
    """
    from chronoset.sinks.writers import _hadoop_path

    tail = F.regexp_extract("file_name", r"((?:/[^/=]+=[^/]+)*/[^/]+)$", 1)
    moves = listed.select("file_name", F.concat(F.lit(archive_dir.rstrip("/")), tail).alias("target"))

    def move(batches):
        from urllib.parse import unquote, urlsplit

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            out = []
            for source, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    store, path = fs.FileSystem.from_uri(source if urlsplit(source).scheme else "file://" + source)
                    aim = unquote(urlsplit(target).path) if urlsplit(target).scheme in ("", "file") else store.normalize_path(fs.FileSystem.from_uri(target)[1])
                except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                    out.append((source, target, None))
                    continue
                there = store.get_file_info(path).type == fs.FileType.File
                if there:
                    store.create_dir(aim.rsplit("/", 1)[0], recursive=True)
                    store.move(path, aim)
                out.append((source, target, there))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 3, (pa.string(), pa.string(), pa.bool_()), strict=True)],
                                             names=["source", "target", "moved"])

    width = spark.sparkContext.defaultParallelism
    done = moves.repartition(width).mapInArrow(move, "source string, target string, moved boolean").checkpoint(eager=True)
    moved = done.agg(F.count_if("moved")).first()[0]
    for r in done.where("moved is null").toLocalIterator():
        store, source = _hadoop_path(spark, r["source"])
        _, target = _hadoop_path(spark, r["target"])
        if store.exists(source):
            store.mkdirs(target.getParent())
            moved += bool(store.rename(source, target))
    return moved
