"""Type 2 history with each key's open version as stream state.

`transformWithState` keeps two rows per key: the open version, and the latest
row of the last day seen, which may still be replaced by a later row of that
day. A row of a newer day settles that day: if a tracked attribute differs the
open version closes, for good, and goes to the append-only sink. No timer runs
and no day is waited for. After each batch a key's rows as they stand now, its
*tail*, are appended too, numbered; the last tail of a key counts.

A row older than its key's last day can change versions that are closed, so
it is only recorded as late; the keys of late rows are rebuilt from all rows
delivered, a batch build of those keys alone. State is two rows a key, however
long the history; the sink holds a row per closed version and, per batch, one
or two for each key that the batch touched.

A restart continues from the checkpoint: the state store and the sink's log
commit together, so no row is lost or doubled. Rows without key or timestamp
are left out. State needs a RocksDB state store, set for the start of the
query only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from chronoset.functions.scalar import open_end
from chronoset.operators import scd2
from chronoset.operators.shape import latest_per_day
from chronoset.schemas import CURRENT_COL, END_COL, START_COL
from chronoset.streaming.ingest import drained, file_stream

CLOSED, TAIL, LATE = "closed", "tail", "late"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Versions(StatefulProcessor):
    """State: start and attributes of the open version (NULL start: none yet), last day, its order values and attributes, a count of tails."""

    def __init__(self, key: str, attrs: list[str], tracked: list[str], order: list[str], state: T.StructType):
        self.key, self.attrs, self.order, self.state_schema = key, attrs, order, state
        self.tracked = [attrs.index(c) for c in tracked]

    def init(self, handle) -> None:
        self.state = handle.getValueState("version", self.state_schema)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        n = len(self.attrs)
        kept = self.state.get() if self.state.exists() else None
        start, opened, day, order, last, seq = None, None, None, None, None, 0
        if kept is not None:
            kept = list(kept)
            start, opened, day = kept[0], tuple(kept[1 : 1 + n]), kept[1 + n]
            order, last, seq = tuple(kept[2 + n : 2 + n + len(self.order)]), tuple(kept[2 + n + len(self.order) : -1]), kept[-1]
        # NULLs come before any value, as in Spark's order
        rank = lambda o, a: [(x is not None, x if x is not None else 0) for x in (*o, *a)]
        got = sorted(((r["_day"], tuple(r[c] for c in self.order), tuple(r[c] for c in self.attrs)) for r in rows), key=lambda g: (g[0], rank(g[1], g[2])))
        for d, o, a in got:
            if day is not None and d < day:
                yield self._row(key, LATE, 0, a, d, None, None)
            elif day is not None and d == day:
                if rank(o, a) > rank(order, last):
                    order, last = o, a
            else:
                if day is not None and (start is None or self._differs(opened, last)):
                    if start is not None:
                        yield self._row(key, CLOSED, 0, opened, start, day, False)
                    start, opened = day, last
                day, order, last = d, o, a
        seq += 1
        self.state.update((start, *(opened or (None,) * n), day, *order, *last, seq))
        if start is None:
            yield self._row(key, TAIL, seq, last, day, None, True)
        elif self._differs(opened, last):
            yield self._row(key, TAIL, seq, opened, start, day, False)
            yield self._row(key, TAIL, seq, last, day, None, True)
        else:
            yield self._row(key, TAIL, seq, opened, start, None, True)

    def _differs(self, a: tuple, b: tuple) -> bool:
        return any(a[i] != b[i] for i in self.tracked)

    def _row(self, key, kind, seq, attrs, start, end, current) -> Row:
        return Row(**{self.key: key[0], "_kind": kind, "_seq": seq, **dict(zip(self.attrs, attrs, strict=True)), START_COL: start, END_COL: end, CURRENT_COL: current})

    def close(self) -> None:
        pass


class OpenState:
    def __init__(self, key: str, attrs: list[str], tracked: list[str], order_cols: list[str]):
        self.key, self.attrs, self.tracked, self.order = key, attrs, tracked, order_cols

    def drain(self, spark: SparkSession, source_dir: str, schema, struct_name: str, sink: str, checkpoint: str,
              max_files_per_trigger: int | None = None, timeout_s: int | None = None) -> None:
        """Fold what is pending below `source_dir` into the state and append to the sink."""
        stream = file_stream(spark, source_dir, schema, "json", max_files_per_trigger)
        flat = stream.select(F.col(f"{struct_name}.{self.key}").alias(self.key), F.to_date(self.order[0]).alias("_day"), *self.order,
                             *[F.col(f"{struct_name}.{a}").alias(a) for a in self.attrs])
        flat = flat.where(F.col(self.key).isNotNull() & F.col("_day").isNotNull())
        kind = {f.name: f.dataType for f in flat.schema.fields}
        attrs = [T.StructField(a, kind[a]) for a in self.attrs]
        state = T.StructType([T.StructField("start", T.DateType()), *[T.StructField(f"open_{f.name}", f.dataType) for f in attrs], T.StructField("day", T.DateType()),
                              *[T.StructField(c, kind[c]) for c in self.order], *attrs, T.StructField("seq", T.LongType())])
        out = T.StructType([T.StructField(self.key, kind[self.key]), T.StructField("_kind", T.StringType()), T.StructField("_seq", T.LongType()), *attrs,
                            T.StructField(START_COL, T.DateType()), T.StructField(END_COL, T.DateType()), T.StructField(CURRENT_COL, T.BooleanType())])
        rows = flat.groupBy(self.key).transformWithState(_Versions(self.key, self.attrs, self.tracked, self.order, state), out, "Append", "None")
        before = spark.conf.get(PROVIDER, None)
        spark.conf.set(PROVIDER, ROCKS)
        try:
            query = rows.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        finally:
            spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)
        drained(query, timeout_s)

    def history(self, spark: SparkSession, sink: str, delivered: DataFrame) -> DataFrame:
        """All versions: closed ones and last tails; the keys of late rows from all rows `delivered` (key, order columns, attributes)."""
        rows = spark.read.parquet(sink)
        late = rows.where(F.col("_kind") == LATE).select(self.key).distinct()
        last = rows.where(F.col("_kind") == TAIL).groupBy(self.key).agg(F.max("_seq").alias("_seq"))
        tails = rows.where(F.col("_kind") == TAIL).join(last, [self.key, "_seq"], "left_semi")
        cols = [self.key, *self.attrs, *scd2.BOOK_COLS]
        kept = rows.where(F.col("_kind") == CLOSED).unionByName(tails).join(late, self.key, "left_anti")
        kept = kept.withColumn(END_COL, F.coalesce(END_COL, open_end())).select(*cols)
        again = delivered.join(late, self.key, "left_semi")
        daily = latest_per_day(again, self.key, F.to_date(self.order[0]), self.order, self.attrs)
        return kept.unionByName(scd2.build(daily, self.key, "day", self.tracked, self.attrs).select(*cols))
