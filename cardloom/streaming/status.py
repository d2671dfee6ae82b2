"""The state of every run while its log grows: stateful streaming with a timer.

The log of a run is folded into the last result of each unit and the counts over them, so a new entry costs
what it changes.  A run is held in ``PARTS`` parts by hash of the unit, which are folded by tasks of their own, and a part's units in
``BLOCKS`` blocks, each of which is read and written once for all entries of a batch that fall into it.  A run that says nothing for a
while is not running any more: a timer in event time turns
it into an interrupted one, and the next entry turns it back.  What current() gives equals state.status() on the same log, but for that.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.state import keep_last
from ..sources import files
from ..sources.session import importable

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Parts of a run and blocks of a part; they stay as they are while a checkpoint lives.
PARTS, BLOCKS = 64, 16
#: Entries of a part that are folded at once.
ROWS = 100_000
#: What is known of a part of a run, times in microseconds.
STATUS = "run string, input_fingerprint string, piece int, n_ok long, n_failed long, n_fatal long, tokens long, updated_us long, error_us long, last_error string, quiet boolean, emitted long"
_COUNTS = "n_ok long, n_failed long, n_fatal long, tokens long, updated_us long, error_us long, last_error string, emitted long"
_UNITS = pa.schema([("unit", pa.string()), ("ok", pa.bool_()), ("fatal", pa.bool_()), ("error", pa.string()), ("tokens", pa.int64()), ("us", pa.int64())])


def _packed(units: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _UNITS) as out:
        out.write_table(pa.Table.from_pandas(units, _UNITS, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpacked(rows: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(rows)).read_pandas()


def _last(units: pd.DataFrame) -> pd.DataFrame:
    """The last row of each unit in order of time, of equal times the later row."""
    return units.sort_values("us", kind="stable").drop_duplicates("unit", keep="last")


def _sums(units: pd.DataFrame) -> tuple[int, int, int, int]:
    n_ok = int(units["ok"].sum())
    return n_ok, len(units) - n_ok, int(units["fatal"].sum()), int(units["tokens"].sum())


class RunStatus(StatefulProcessor):
    """Units of a part of a run with their last results, and the counts over them."""

    def __init__(self, quiet_ms: int):
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.blocks = handle.getMapState("blocks", "block int", "rows binary")
        self.errors = handle.getMapState("errors", "block int", "us long, error string")
        self.counts = handle.getValueState("counts", _COUNTS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        *sums, updated, _, _, emitted = self.counts.get() if self.counts.exists() else (0, 0, 0, 0, None, None, None, 0)
        held, n = [], 0
        for frame in rows:
            held.append(frame[[*_UNITS.names, "block"]])
            n += len(frame)
            latest = int(frame["us"].max())
            updated = latest if updated is None else max(updated, latest)
            if n >= ROWS:
                sums, held, n = self._folded(sums, held), [], 0
        sums = self._folded(sums, held) if held else sums
        error_at, error = max((tuple(v) for _, v in self.errors.iterator()), default=(None, None))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if updated is not None and not sums[1] and not sums[2]:  # failed ones say more than silence
            self.handle.registerTimer(updated // 1000 + self.quiet_ms)
        yield self._emitted(key, (*sums, updated, error_at, error, emitted + 1), False)

    def _folded(self, sums: list[int], frames: list[pd.DataFrame]) -> list[int]:
        """The sums after some entries, whose blocks are brought up to date."""
        for block, own in _last(pd.concat(frames, ignore_index=True)).groupby("block"):
            place, own = (int(block),), own[_UNITS.names]
            old = _unpacked(self.blocks.getValue(place)[0]) if self.blocks.containsKey(place) else own[:0]
            now = _last(pd.concat([old, own], ignore_index=True)) if len(old) else own
            self.blocks.updateValue(place, (_packed(now),))
            failed = now[now["error"].notna()]
            if len(failed):
                self.errors.updateValue(place, (int(failed["us"].iloc[-1]), failed["error"].iloc[-1]))
            elif old["error"].notna().any():
                self.errors.removeKey(place)
            sums = [x + more - less for x, more, less in zip(sums, _sums(now), _sums(old))]
        return sums

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        *counts, emitted = self.counts.get()
        yield self._emitted(key, (*counts, emitted + 1), True)

    def _emitted(self, key, counts: tuple, quiet: bool) -> pd.DataFrame:
        self.counts.update(counts)
        *said, emitted = counts
        names = [c.split()[0] for c in STATUS.split(", ")]
        return pd.DataFrame([(*key, *said, quiet, emitted)], columns=names).astype({"updated_us": "Int64", "error_us": "Int64"})

    def close(self) -> None:
        pass


def live(log: DataFrame, inputs: DataFrame, quiet: str = "10 minutes", late: str = "0 seconds") -> DataFrame:
    """Rows of STATUS from a stream of log entries (the columns of RUN_LOG) of the inputs in a table.

    A part of a run has a new row whenever entries came or its timer went off; ``emitted`` numbers them.  Entries more than ``late`` behind the newest time
    of the batches before are left out, as are those without run, fingerprint, unit or time, and of inputs that are not in the table.
    """
    spark = importable(log).sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    quiet_ms = int(pd.Timedelta(quiet).total_seconds() * 1000)
    known, hashed = inputs.select("run", "input_fingerprint").distinct(), F.xxhash64("unit")
    own = log.select(
        "run", "input_fingerprint", F.pmod(hashed, F.lit(PARTS)).cast("int").alias("piece"), F.pmod(F.shiftright(hashed, 32), F.lit(BLOCKS)).cast("int").alias("block"), "unit",
        F.coalesce("ok", F.lit(False)).alias("ok"), F.coalesce("fatal", F.lit(False)).alias("fatal"), "error", F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"),
        F.col("at").cast("timestamp").alias("at"), F.unix_micros(F.col("at").cast("timestamp")).alias("us"),
    )
    joined = own.where("run IS NOT NULL AND input_fingerprint IS NOT NULL AND unit IS NOT NULL AND at IS NOT NULL").join(known, ["run", "input_fingerprint"]).withWatermark("at", late)
    return joined.groupBy("run", "input_fingerprint", "piece").transformWithStateInPandas(RunStatus(quiet_ms), STATUS, "Update", "EventTime")


def kept(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Work off what is there and keep each batch's rows under its number; read with current()."""

    def work(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/part=number-{number}")

    return rows.writeStream.foreachBatch(work).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str, inputs: DataFrame) -> DataFrame:
    """The state of every input by the newest rows of its parts; inputs without an entry are pending."""
    rows = keep_last(files.parquet_if_there(spark, path, STATUS).select(*[c.split()[0] for c in STATUS.split(", ")]), ["run", "input_fingerprint", "piece"], "emitted")
    runs = rows.groupBy("run", "input_fingerprint").agg(
        *[F.sum(c).alias(c) for c in ("n_ok", "n_failed", "n_fatal", "tokens")],
        F.timestamp_micros(F.max("updated_us")).alias("updated_at"),
        F.max_by("last_error", "error_us").alias("last_error"),
        F.max(F.struct("updated_us", "quiet"))["quiet"].alias("quiet"),  # a run is as quiet as its newest part
    )
    status = (
        F.when(F.col("n_ok").isNull(), "pending")
        .when(F.col("n_fatal") > 0, "fatal")
        .when(F.col("n_ok") >= F.col("total_units"), "completed")
        .when((F.col("n_failed") > 0) | F.col("quiet"), "interrupted")
        .otherwise("running")
    )
    return inputs.join(runs, ["run", "input_fingerprint"], "left").withColumn("status", status).drop("n_fatal", "quiet")
