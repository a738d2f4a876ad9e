"""The dimension as Spark bucketed tables: a folder and a small pointer file per version.

Every version is a table of its own, written once: partitioned by `is_current`,
bucketed and sorted by the key (`bucketBy`/`sortBy`). A join or window on the
key reads the open rows without moving them; only the stage is shuffled, into
as many partitions as there are buckets.

* `versions/v=N/`: all open rows as of version N, and the rows it closed;
* `pointer/v=N.json`: a small file that says what version N consists of: its own
  open rows and the closed rows of the versions in `closed`. A version exists once
  its pointer does, so a crash leaves the version before in force, and its
  folder is overwritten by the next commit.

A version either adds the rows it closed to those of the versions before, or
(`replace`) holds all closed rows itself: for a late or corrected day, and
after `compact_every` versions, so a reader opens a bounded number of tables.
The version before the last stays readable; folders neither of the two needs
are removed after the commit. The tables are registered in the session's
catalog from the schema in the pointer, so any session can read them.

Choose `buckets` so that the open rows of one bucket are a few hundred MB.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoset.schemas import CURRENT_COL
from chronoset.sinks.writers import delete_path, list_dirs, list_files, read_text, write_text

EMPTY = {"version": 0, "closed": [], "max_day": None, "runs": {}, "snapshots": [], "corrected": False, "schema": None, "key": None, "buckets": None}


def _table(path: str) -> str:
    return "dim_" + hashlib.md5(path.encode()).hexdigest()


def write_bucketed(parts: list[DataFrame], path: str, key: str, buckets: int, partition_by: str | None = None) -> None:
    """Rows as a bucketed, sorted table at `path`: a file for each part, bucket and partition.

    Rows that are dealt like the buckets already, such as the rows of another
    version, are written where they are: Spark leaves out the exchange.
    """
    for mode, rows in zip(["overwrite", *["append"] * len(parts)], parts, strict=False):
        w = rows.repartition(buckets, key).write.mode(mode).format("parquet").option("path", path)
        if mode == "overwrite":
            w = w.option("partitionOverwriteMode", "static")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.bucketBy(buckets, key).sortBy(key).saveAsTable(_table(path))


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int, partition_by: str | None = None) -> DataFrame:
    """The table at `path` with its bucketing, registered in this session if need be."""
    name = _table(path)
    if not spark.catalog.tableExists(name):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f"PARTITIONED BY (`{partition_by}`) " if partition_by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet {parts}"
                  f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
        if partition_by:
            spark.catalog.recoverPartitions(name)
    return spark.table(name)


def forget(spark: SparkSession, path: str) -> None:
    """Remove a table's files and its name."""
    spark.sql(f"DROP TABLE IF EXISTS {_table(path)}")
    delete_path(spark, path)


class Dimension:
    def __init__(self, spark: SparkSession, base: str, key: str | None = None, buckets: int = 8, compact_every: int = 64):
        self.spark, self.base, self.key, self.buckets, self.compact_every = spark, base.rstrip("/"), key, buckets, compact_every

    def _folder(self, v: int) -> str:
        return f"{self.base}/versions/v={v}"

    def _pointer(self, v: int) -> str:
        return f"{self.base}/pointer/v={v}.json"

    def _pointers(self) -> list[int]:
        names = list_files(self.spark, f"{self.base}/pointer")
        return sorted(int(n[2:-5]) for n in names if n.endswith(".json"))

    def state(self) -> dict:
        """What the last committed version's pointer says."""
        found = self._pointers()
        return self._at(found[-1]) if found else dict(EMPTY)

    def _at(self, v: int) -> dict:
        st = json.loads(read_text(self.spark, self._pointer(v)))
        return st | {"max_day": dt.date.fromisoformat(st["max_day"]) if st["max_day"] else None}

    def version(self) -> int:
        return self.state()["version"]

    def _version(self, v: int, st: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(st["schema"]))
        df = read_bucketed(self.spark, self._folder(v), schema, st["key"], st["buckets"], CURRENT_COL)
        return df.select(*schema.names)

    def aligned(self, rows: DataFrame) -> DataFrame:
        """Rows dealt like the buckets, so that they meet the dimension without moving it."""
        return rows.repartition(self.buckets, self.key)

    def read_current(self, state: dict | None = None) -> DataFrame | None:
        """Open rows (S3): one partition of one bucketed table."""
        st = state or self.state()
        return self._version(st["version"], st).where(F.col(CURRENT_COL)) if st["version"] else None

    def read_closed(self, state: dict | None = None) -> DataFrame | None:
        st = state or self.state()
        parts = [self._version(v, st).where(~F.col(CURRENT_COL)) for v in st["closed"] or []]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def read(self, version: int | None = None) -> DataFrame | None:
        """The last version whole, or the one before it; None when nothing is there."""
        st = self.state() if version is None else self._at(version)
        if not st["version"]:
            return None
        if st["closed"] == [st["version"]]:
            return self._version(st["version"], st)
        closed, current = self.read_closed(st), self.read_current(st)
        return current if closed is None else closed.unionByName(current)

    def commit(self, rows: DataFrame | list[DataFrame], replace: bool = True, state: dict | None = None, **told) -> int:
        """Write the next version and point to it.

        `rows` (one or more parts) holds all open rows and, with `replace`, all
        closed ones, else only those closed since the last version. `told`
        goes to the pointer: max_day, runs, snapshots, corrected.
        """
        before = state or self.state()
        v = before["version"] + 1
        parts = rows if isinstance(rows, list) else [rows]
        names = parts[0].columns
        if not replace and len(before["closed"]) >= self.compact_every:
            parts, replace = [*parts, self.read_closed(before)], True
        # partition columns come last in a table
        names = [*[c for c in names if c != CURRENT_COL], CURRENT_COL]
        schema = T.StructType([parts[0].schema[c] for c in names])
        forget(self.spark, self._folder(v))
        write_bucketed([p.select(*names) for p in parts], self._folder(v), self.key, self.buckets, CURRENT_COL)
        st = before | told | {"version": v, "closed": [v] if replace else [*before["closed"], v], "schema": schema.json(), "key": self.key, "buckets": self.buckets}
        write_text(self.spark, self._pointer(v), json.dumps(st, default=str))
        self._clean(before, st)
        return v

    def _clean(self, before: dict, now: dict) -> None:
        """Remove folders and pointers that neither the last version nor the one before it reads."""
        needed = {now["version"], before["version"], *now["closed"], *(before["closed"] or [])}
        for name in list_dirs(self.spark, f"{self.base}/versions"):
            if int(name.split("=", 1)[1]) not in needed:
                forget(self.spark, f"{self.base}/versions/{name}")
        for v in self._pointers():
            if v not in (now["version"], before["version"]):
                delete_path(self.spark, self._pointer(v))
