"""De-duplication and hand-kept state per key."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from meterlane.functions.numbers import total
from meterlane.streaming.aggregates import watermarked
from meterlane.streaming.run import STATE_PARTITIONS

# Workers get the classes below with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def deduplicated(df: DataFrame, ids: list[str], time: str, late: str) -> DataFrame:
    """First arrival of each id; copies are recognised within the watermark delay."""
    timed = watermarked(df, time, late)
    return timed.dropDuplicatesWithinWatermark(ids) if df.isStreaming else timed.dropDuplicates(ids)


class RunningTotals(StatefulProcessor):
    """Rows and amount seen so far of each (key, salt), from partial totals."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("seen", "trips long, amount double")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        trips, amount = self._seen.get() if self._seen.exists() else (0, 0.0)
        for row in rows:
            trips += row.trips
            amount += row.amount
        self._seen.update((trips, amount))
        yield Row(key=key[0], salt=key[1], trips=trips, amount=amount)

    def close(self) -> None:
        pass


# Rows that a map task adds up at a time, and rows of a key for which another salt is worth its state entry.
PORTION = 1 << 19
ROWS_PER_SALT = 32
PARTIAL = "key long, salt int, trips long, amount double"


def _portions(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= size:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _partial(portion: pa.Table, salts: int) -> pa.RecordBatch:
    """One row per (key, salt) of a portion.

    A key gets as many salts as it has fair shares of the portion's rows, so only hot keys have several, and
    a portion of k keys makes at most k + ``salts`` rows.
    """
    keys = portion["key"].combine_chunks().dictionary_encode(null_encoding="encode")
    code = keys.indices.to_numpy()
    rows = np.bincount(code, minlength=len(keys.dictionary))
    own = np.minimum(-(-rows * salts // len(code)), -(-rows // ROWS_PER_SALT)).clip(1, salts)
    group, at = np.unique(code * np.int64(salts) + portion["hash"].to_numpy() % own[code], return_inverse=True)
    amount = portion["amount"].to_numpy()
    return pa.RecordBatch.from_arrays([
        keys.dictionary.take(pa.array(group // salts)), pa.array((group % salts).astype("int32")),
        pa.array(np.bincount(at, minlength=len(group)).astype("int64")),
        pa.array(np.bincount(at, np.where(np.isnan(amount), 0.0, amount), len(group)))],
        ["key", "salt", "trips", "amount"])


def keyed_totals(df: DataFrame, key: str, spread_by: str, amount: str, salts: int | None = None) -> DataFrame:
    """Running totals of every (key, salt), emitted after each micro-batch; missing amounts add nothing.

    Map tasks add up their rows by portions first, so state is read and written once per entry, not per row.
    A hot key's rows are spread over up to ``salts`` state entries, so that no task owns it;
    by default as many as a new stream gets state partitions. Other keys have one entry.
    A stream that goes on from a checkpoint may change the number: ``folded`` adds up all entries.
    Which salt a row gets may depend on its neighbours, so ``df`` should come from its source without a shuffle.
    """
    conf = df.sparkSession.conf
    salts = salts or int(conf.get(STATE_PARTITIONS, None) or conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(key).cast("long").alias("key"), F.xxhash64(spread_by).alias("hash"),
                     F.col(amount).cast("double").alias("amount"))
    partial = rows.mapInArrow(lambda batches: (_partial(p, salts) for p in _portions(batches, PORTION)), PARTIAL)
    return partial.groupBy("key", "salt").transformWithState(
        statefulProcessor=RunningTotals(), outputStructType=PARTIAL, outputMode="Update", timeMode="None")


def folded(totals: DataFrame) -> DataFrame:
    """Latest totals of all salts of a key added up."""
    return totals.groupBy("key").agg(F.sum("trips").alias("trips"), total("amount").alias("amount"))
