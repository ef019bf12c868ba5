"""Profiles of a stream that keep their own state: counts, moments and exact distinct values of each column and window.

A row of the stream becomes one (column, value) for each profiled column; they
meet under (window, column, part), the part being a hash of the value, so one
column's values are spread over tasks and no value is counted in two places.
State is merged numbers and a map of distinct values, on the executors' disks
(RocksDB).  A window is closed by a timer in the batch after the watermark has
passed it: its state goes, and rows that come later are left out.  State can start from
the parts of a profile that was stored before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.stats import clean

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: One row for each key and batch: what the key holds by then; closed when nothing can be added any more.
PARTS = "window_start timestamp, column string, part int, rows bigint, nulls bigint, distinct_values bigint, total double, least double, most double, closed boolean"
#: What state can start from: PARTS and the distinct values behind them.
STORED = "window_start timestamp, column string, part int, rows bigint, nulls bigint, total double, least double, most double, values array<string>"
_NUMBERS = "rows bigint, nulls bigint, distinct_values bigint, total double, least double, most double"


class _Profile(StatefulProcessor):
    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.numbers = handle.getValueState("numbers", _NUMBERS)
        self.values = handle.getMapState("values", "value string", "seen boolean")

    def _now(self) -> list:
        return list(self.numbers.get()) if self.numbers.exists() else [0, 0, 0, 0.0, None, None]

    def _row(self, key, now: list, closed: bool) -> pd.DataFrame:
        rows, nulls, distinct, total, least, most = now
        return pd.DataFrame({"window_start": [key[0]], "column": [key[1]], "part": [key[2]], "rows": [rows], "nulls": [nulls], "distinct_values": [distinct], "total": [total], "least": [least], "most": [most], "closed": [closed]})

    def _add(self, now: list, rows: int, nulls: int, values, total: float, least, most) -> list:
        for v in values:
            if not self.values.containsKey((v,)):
                self.values.updateValue((v,), (True,))
                now[2] += 1
        ends = lambda pick, a, b: b if a is None else a if b is None else pick(a, b)
        return [now[0] + rows, now[1] + nulls, now[2], now[3] + total, ends(min, now[4], least), ends(max, now[5], most)]

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        now = self._now()
        for r in initialState.itertuples(index=False):
            some = lambda x: None if pd.isna(x) else float(x)
            now = self._add(now, int(r.rows), int(r.nulls), list(r.values), float(r.total), some(r.least), some(r.most))
        self.numbers.update(tuple(now))
        self._remind(key)

    def _remind(self, key) -> None:
        if not list(self.handle.listTimers()):
            self.handle.registerTimer(int(pd.Timestamp(key[0]).timestamp() * 1000) + self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = self._now()
        for f in rows:
            held = f["value"].dropna()
            numbers = f["number"].dropna()
            now = self._add(now, len(f), len(f) - len(held), held.unique(), float(numbers.sum()), float(numbers.min()) if len(numbers) else None, float(numbers.max()) if len(numbers) else None)
        self.numbers.update(tuple(now))
        self._remind(key)
        yield self._row(key, now, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = self._now()
        self.numbers.clear()
        self.values.clear()
        yield self._row(key, now, True)

    def close(self) -> None:
        pass


def _keyed(stream: DataFrame, time_col: str, columns: Sequence[str], window: str, late: str | None, parts: int) -> DataFrame:
    """(window_start, column, part, at, value, number), a row for each row and column."""
    one = []
    for c in columns:
        v = clean(stream, c)
        number = v.cast("double") if isinstance(stream.schema[c].dataType, T.NumericType) else F.lit(None).cast("double")
        text = v.cast("string")
        one.append(F.struct(F.lit(c).alias("column"), text.alias("value"), number.alias("number"), F.coalesce(F.pmod(F.hash(text), F.lit(parts)), F.lit(0)).alias("part")))
    timed = stream.withColumn("at", F.col(time_col).cast("timestamp")).where("at IS NOT NULL")
    if late:
        timed = timed.withWatermark("at", late)
    return timed.select("at", F.window("at", window)["start"].alias("window_start"), F.inline(F.array(*one)))


def profile_stream(stream: DataFrame, time_col: str, columns: Sequence[str], window: str = "1 day", late: str = "2 hours", parts: int = 8, stored: DataFrame | None = None) -> DataFrame:
    """A stream of PARTS, for output mode update; `merged` puts them together.

    stored: rows of STORED, by `stored_profile`, that the state starts from,
    with the same columns, window and parts.  Rows without a time are left out.
    The session's state store must be RocksDB.
    """
    spark = stream.sparkSession
    length = spark.sql(f"SELECT CAST(unix_millis(TIMESTAMP '1970-01-01 00:00:00 UTC' + INTERVAL '{window}') AS BIGINT)").first()[0]
    keys = ["window_start", "column", "part"]
    start = None if stored is None else stored.groupBy(*keys)
    grouped = _keyed(stream, time_col, columns, window, late, parts).groupBy(*keys)
    return grouped.transformWithStateInPandas(_Profile(length), PARTS, "Update", "EventTime", start)


def stored_profile(df: DataFrame, time_col: str, columns: Sequence[str], window: str = "1 day", parts: int = 8) -> DataFrame:
    """STORED rows of a table: the profile that a stream goes on from."""
    rows = _keyed(df, time_col, columns, window, None, parts).groupBy("window_start", "column", "part")
    number = F.col("number")
    return rows.agg(
        F.count("*").alias("rows"), F.count_if(F.col("value").isNull()).alias("nulls"), F.coalesce(F.sum(number), F.lit(0.0)).alias("total"), F.min(number).alias("least"), F.max(number).alias("most"), F.collect_set("value").alias("values"),
    )


def merged(parts: DataFrame) -> DataFrame:
    """(window_start, column, rows, nulls, distinct_values, mean, least, most) of PARTS as they were emitted: the last row of each key counts, which has the most rows."""
    last = parts.groupBy("window_start", "column", "part").agg(F.max_by(F.struct("rows", "nulls", "distinct_values", "total", "least", "most"), "rows").alias("p")).select("window_start", "column", "p.*")
    total = last.groupBy("window_start", "column").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.sum("distinct_values").alias("distinct_values"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"))
    held = F.col("rows") - F.col("nulls")
    return total.withColumn("mean", F.when((held > 0) & F.col("least").isNotNull(), F.col("total") / held)).drop("total")


def run_profile(parts: DataFrame, folder: str) -> DataFrame:
    """Runs a stream of PARTS over all that is there, batch by batch, and returns what it emitted.

    Each batch has a folder of its own, so one that runs twice replaces itself.
    """
    spark, key = parts.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)

    def emit(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/parts/batch={number}")

    try:
        parts.writeStream.outputMode("update").foreachBatch(emit).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)
    return spark.read.schema(PARTS).parquet(f"{folder}/parts/*")
