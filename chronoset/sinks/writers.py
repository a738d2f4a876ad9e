"""Load modes and table layouts on plain parquet.

Without a row-level table format, what a warehouse would do with DELETE is
expressed as partition replacement: a fact table is parquet partitioned by
date; a reload replaces exactly the dates it carries (dynamic partition
overwrite) and, on request, clears dates that came back empty. The dimension's
versions are in `chronoset.sinks.dimension`.

Writes happen on the executors; the driver only sees commit metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chronoset.schemas import TS_NTZ_FORMAT


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below `path` (metadata only)."""
    fs, p = _hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files directly in one folder (metadata only)."""
    fs, p = _hadoop_path(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isFile()] if fs.exists(p) else []
    return [n for n in names if not n.startswith(("_", "."))]


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small metadata file, read by the driver; None where it is absent."""
    fs, p = _hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small metadata file, written aside and moved into place, so a reader finds it whole or not at all."""
    fs, aside = _hadoop_path(spark, path + ".tmp")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    delete_path(spark, path)
    move_path(spark, path + ".tmp", path)


def move_path(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder; its parent folders are made."""
    fs, source = _hadoop_path(spark, path)
    _, aim = _hadoop_path(spark, target)
    fs.mkdirs(aim.getParent())
    if not fs.rename(source, aim):
        raise OSError(f"could not move {path} to {target}")


def write_counted(df: DataFrame, path: str, mode: str, partition_by=None, fmt: str = "parquet",
                  options: dict | None = None) -> int:
    """Write and return the number of rows written, counted during the write
    itself by an Observation (no second pass)."""
    obs = Observation("rows_written")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)
    return int(obs.get.get("rows", 0))


def load_append(df: DataFrame, path: str, partition_by=None, fmt: str = "parquet") -> int:
    """Append rows (K2); a re-run appends again (not idempotent)."""
    return write_counted(df, path, "append", partition_by, fmt)


def load_overwrite(df: DataFrame, path: str, partition_by=None, fmt: str = "parquet") -> int:
    """Truncate then load (K3): the whole table is replaced."""
    return write_counted(df, path, "overwrite", partition_by, fmt, {"partitionOverwriteMode": "static"})


def replace_partitions(df: DataFrame, path: str, cols: list[str], fmt: str = "parquet") -> int:
    """Dynamic partition overwrite: exactly the partitions present in `df`
    are replaced, whatever the session's default overwrite mode is.

    The mode is an option of this write, not a setting of the session, so
    writes that run side by side cannot meet each other's mode. Rows are
    rebalanced on the partition columns: a partition is normally one file, and
    a hot one is split at run time.
    """
    return write_counted(df.hint("rebalance", *cols), path, "overwrite", cols, fmt, {"partitionOverwriteMode": "dynamic"})


def replace_by_date(df: DataFrame, path: str, date_col: str, dates: list | None = None, fmt: str = "parquet") -> int:
    """Idempotent reload of whole dates.

    Dates present in `df` are replaced, all other dates are kept (dynamic
    partition overwrite). Dates listed in `dates` but absent from `df` are
    emptied as well, which a dynamic overwrite alone would not do: they are
    removed first, so the input is read once.
    """
    for d in dates or []:
        delete_path(df.sparkSession, f"{path.rstrip('/')}/{date_col}={d}")
    return replace_partitions(df, path, [date_col], fmt)


def write_daily_json(df: DataFrame, path: str, date_col: str = "file_date", mode: str = "overwrite") -> int:
    """JSON-lines output with one folder per date (K8).

    The rows are rebalanced on the date over the shuffle width (`REBALANCE`
    hint): rows of one date go to one task, so a date is normally one file,
    and AQE splits a hot date (one holding a large share of the rows) over
    several tasks at run time instead of funnelling it into one. No job runs
    to decide any of this, and no setting of the session is touched.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return write_counted(df.hint("rebalance", width, date_col), path, mode, date_col, "json",
                         {"timestampNTZFormat": TS_NTZ_FORMAT, "ignoreNullFields": "false"})
