"""Keyed state of streams: rolling means over stored slices, rows behind the watermark, repeated rows."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, StringType, StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
HOUR_US = 3_600_000_000
AT = "micros"
PACK, PACK_BYTES = 1 << 18, 1 << 25  # rows a task packs at a time, or fewer that take so many bytes
CODEC = pa.Codec("zstd", 1)
WAVES = 2


def keep_state(spark: SparkSession) -> None:
    """Settings of queries with keyed state: on the executors' disks, changes alone in the checkpoint.

    Workers find this package where the driver found it; on a cluster it is installed or sent along.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


class Pack:
    """Rows of a task packed by key, in order of the first number: their numbers and, as an Arrow stream, the other columns, compressed.

    Keyed state gets its rows one by one from Spark, which costs more than any work on them; so it gets packs. They are
    shuffled twice, all rows of a micro-batch, so they are to be small: numbers in order and columns of few values are.
    """

    def __init__(self, *numbers: str):
        self.numbers = numbers
        self.schema = ", ".join(["key string", *[f"{c} binary" for c in numbers], "rest binary"])

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= PACK or sum(b.nbytes for b in held) >= PACK_BYTES:
                yield self._packs(held)
                held = []
        if any(b.num_rows for b in held):
            yield self._packs(held)

    def _packs(self, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        place = pc.dictionary_encode(rows["key"].combine_chunks(), null_encoding="encode").indices.to_numpy()
        order = np.lexsort((rows[self.numbers[0]].to_numpy(), place))
        rows = rows.take(pa.array(order)).combine_chunks()
        cuts = np.flatnonzero(np.diff(place[order], prepend=-1, append=-1))
        rest = rows.drop_columns(["key", *self.numbers])
        numbers = {c: rows[c].to_numpy() for c in self.numbers}
        packs = {"key": rows["key"].combine_chunks().take(pa.array(cuts[:-1]))}
        for c, values in numbers.items():
            packs[c] = pa.array([_squeezed(values[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())
        packs["rest"] = pa.array([_stream(rest.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])], pa.binary())
        return pa.RecordBatch.from_pydict(packs)


def _stream(rows: pa.Table) -> bytes:
    rows = pa.table([_coded(c) for c in rows.columns], names=rows.column_names)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=CODEC)) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _coded(column: pa.ChunkedArray) -> pa.Array:
    """A column of repeated numbers or texts as a dictionary; any other as it is."""
    plain = column.combine_chunks()
    kind = plain.type
    if not (pa.types.is_float64(kind) or pa.types.is_integer(kind) or pa.types.is_string(kind)):
        return plain
    # Bits of a float, so that zeros keep their sign.
    coded = (plain.view(pa.int64()) if pa.types.is_float64(kind) else plain).dictionary_encode()
    if 2 * len(coded.dictionary) > len(plain):
        return plain
    return pa.DictionaryArray.from_arrays(coded.indices, coded.dictionary.view(kind)) if pa.types.is_float64(kind) else coded


def _decoded(rows: pa.Table) -> pa.Table:
    columns = [c.combine_chunks() for c in rows.columns]
    return pa.table([c.dictionary_decode() if pa.types.is_dictionary(c.type) else c for c in columns], names=rows.column_names)


def _squeezed(values: np.ndarray) -> bytes:
    """Numbers behind their count, compressed: integers as differences, all numbers' first bytes, then all second bytes and so on."""
    steps = np.diff(values, prepend=values.dtype.type(0)) if values.dtype == np.int64 else values
    planes = np.ascontiguousarray(np.ascontiguousarray(steps).view(np.uint8).reshape(-1, values.itemsize).T)
    return len(values).to_bytes(8, "little") + CODEC.compress(planes, asbytes=True)


def _numbers(packed, kind: type) -> np.ndarray:
    """What ``_squeezed`` got."""
    packed, size = memoryview(packed), np.dtype(kind).itemsize
    n = int.from_bytes(packed[:8], "little")
    planes = np.frombuffer(CODEC.decompress(packed[8:], n * size), np.uint8)
    values = np.ascontiguousarray(planes.reshape(size, n).T).view(kind).reshape(n)
    return np.cumsum(values) if values.dtype == np.int64 else values


class Unpack:
    """The rows of packs that are kept, with their times and, where the packs have them, their means."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pack = {c: batch[c][i].as_buffer() for c in batch.schema.names}
                kept = _numbers(pack["kept"], bool)
                rows = _decoded(pa.ipc.open_stream(pack["rest"]).read_all()).add_column(0, AT, pa.array(_numbers(pack[AT], np.int64)))
                if "mean" in pack:
                    rows = rows.append_column("mean", pa.array(_numbers(pack["mean"], float), mask=_numbers(pack["missing"], bool)))
                yield from (rows if kept.all() else rows.filter(pa.array(kept))).to_batches()


def _cut(values: np.ndarray, sizes: list[int]) -> Iterator[bytes]:
    return (_squeezed(x) for x in np.split(values, np.cumsum(sizes)[:-1]))


class RollingMean(StatefulProcessor):
    """Mean of a key's values over [time - width, time], for every row of a micro-batch; rows come and go in packs.

    State per key and time slice: the slice's total, and its distinct times with their sums and counts. A batch reads totals
    of the slices its windows span, and times only of the slices that windows begin in or rows fall in; it writes the
    slices that got rows and that windows of later rows can reach. A timer lets a slice go when the watermark has passed the
    last window that can reach it. Of a key's newest row in a batch the next watermark is ``delay_us`` behind at most; where
    other watermarks may hold it back, ``delay_us`` is None and all slices are written.
    """

    schema = f"{AT} binary, rest binary, kept binary, mean binary, missing binary"

    def __init__(self, width_us: int, slice_us: int, delay_us: int | None = None):
        self.width, self.slice, self.delay = width_us, slice_us, delay_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getMapState("totals", "slice bigint", "total double, n bigint")
        self.times = handle.getMapState("times", "slice bigint", "at binary, total binary, n binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        packs = pd.concat(list(rows), ignore_index=True)
        times = [_numbers(x, np.int64) for x in packs[AT]]
        sizes = [len(x) for x in times]
        at, values = np.concatenate(times), np.concatenate([_numbers(x, float) for x in packs["rolled"]])
        del times
        # Slices may be gone behind the watermark.
        kept = at >= timerValues.getCurrentWatermarkInMs() * 1000
        if not kept.any():
            return
        mean, missing = np.zeros(len(at)), np.ones(len(at), bool)
        mean[kept], missing[kept] = self._means(key, at[kept], values[kept])
        done = zip(packs[AT], packs["rest"], _cut(kept, sizes), _cut(mean, sizes), _cut(missing, sizes))
        for pack in done:
            yield pd.DataFrame([pack], columns=[AT, "rest", "kept", "mean", "missing"])

    def _means(self, key, at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The mean of each row and whether it is missing; the rows' slices are stored."""
        known = np.isfinite(values) & (key[0] is not None)
        new = _summed(at[known], values[known], np.ones(known.sum(), np.int64))
        new_slice = new[0] // self.slice
        begin, end = (int(at.min()) - self.width) // self.slice, int(at.max()) // self.slice
        opened = {*np.unique(at // self.slice).tolist(), *np.unique((at - self.width) // self.slice).tolist()}
        parts = [_EMPTY]
        stored = self._totals(begin, end)
        for number, (total, n) in stored.items():
            # No window begins or ends in a slice that is not opened, so its total may stand at its start.
            parts.append(self._slice(number) if number in opened else (np.array([number * self.slice]), np.array([total]), np.array([n])))
        # The watermark counts whole milliseconds.
        passed = None if self.delay is None else int(at.max()) - 1000 - self.delay - self.width
        for number in np.unique(new_slice).tolist():
            mine = tuple(x[new_slice == number] for x in new)
            parts.append(mine)
            if passed is not None and (number + 1) * self.slice <= passed:
                continue
            if number in stored:
                mine = _summed(*(np.concatenate(x) for x in zip(self._slice(number), mine)))
            else:
                self.handle.registerTimer(((number + 1) * self.slice + self.width) // 1000 + 1)
            self.times.updateValue((number,), tuple(x.tobytes() for x in mine))
            self.totals.updateValue((number,), (float(mine[1].sum()), int(mine[2].sum())))
        times, totals, counts = _summed(*(np.concatenate(x) for x in zip(*parts)))
        # Sums are differences of running totals, so these get the longest float there is.
        totals, counts = (np.concatenate(([0], np.cumsum(x, dtype=t))) for x, t in ((totals, np.longdouble), (counts, np.int64)))
        low, high = np.searchsorted(times, at - self.width, "left"), np.searchsorted(times, at, "right")
        n = counts[high] - counts[low]
        mean = ((totals[high] - totals[low]) / np.maximum(n, 1)).astype(float)
        return mean, n == 0

    def _slice(self, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(np.frombuffer(x, t) for x, t in zip(self.times.getValue((number,)), (np.int64, float, np.int64)))

    def _totals(self, begin: int, end: int) -> dict[int, tuple]:
        """Stored totals of the slices from ``begin`` to ``end``; few others are held, as the timers let them go."""
        return {k[0]: v for k, v in self.totals.iterator() if begin <= k[0] <= end}

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number = ((expiredTimerInfo.getExpiryTimeInMs() - 1) * 1000 - self.width) // self.slice - 1
        self.totals.removeKey((number,))
        self.times.removeKey((number,))
        return iter([])

    def close(self) -> None:
        pass


_EMPTY = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))


def _summed(at: np.ndarray, total: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct times in order with the sums of what belongs to them."""
    if not len(at):
        return _EMPTY
    order = np.argsort(at, kind="stable")
    at, first = np.unique(at[order], return_index=True)
    return at, np.add.reduceat(total[order], first), np.add.reduceat(n[order], first)


def rolling_stream(stream: DataFrame, key: str, ts: str, value: str, out: str, hours: int = 24, delay: str = "1 hour",
                   unique: list[str] | None = None, slice_minutes: int = 240) -> DataFrame:
    """The stream's rows with the mean of their key's values over the last ``hours``, rows of equal time and of the same micro-batch included.

    Rows more than ``delay`` behind the newest time are left out (``late_rows`` has them), and so are rows
    without a time. ``unique`` names columns that tell rows apart: of rows that agree in them one stays, if they arrive within ``delay``.
    A missing, NaN or infinite value adds nothing; a row without a key of text has no mean, rows without a key of another type are
    a group of their own, as in SQL.

    A micro-batch's rows of one key are held by one task (the source's ``files_per_batch`` bounds them). Of a key's state a task holds the
    slices that the batch's windows begin in or its rows fall in: ``slice_minutes`` is to be short where a key has many readings.
    """
    keep_state(stream.sparkSession)
    rows = stream.where(F.col(ts).isNotNull()).withWatermark(ts, delay)
    if unique:
        rows = rows.dropDuplicatesWithinWatermark(unique)
    if hours * 60 % slice_minutes:
        raise ValueError("a window must be a whole number of slices")
    group = F.col(key)
    if not isinstance(stream.schema[key].dataType, StringType):
        # Workers would see a missing number as NaN, which equals no other, so that each row were a group in the order it came.
        group = F.coalesce(group.cast("string"), F.lit(""))
    # Workers see plain column names (theirs must be Python identifiers), and the time as a number that no time zone touches.
    payload = {c: f"c{i}" for i, c in enumerate(stream.columns) if c != ts}
    timed = rows.select(F.unix_micros(F.col(ts).cast("timestamp")).alias(AT), F.col(value).cast("double").alias("rolled"),
                        *[F.col(f"`{c}`").alias(n) for c, n in payload.items()], group.alias("key"))
    shape = StructType([timed.schema[c] for c in (AT, *payload.values())]).add("mean", DoubleType())
    processor = RollingMean(hours * HOUR_US, slice_minutes * 60_000_000, _delay_us(stream, delay))
    means = _by_key(timed, Pack(AT, "rolled"), processor, shape)
    return means.select(*_named(stream.columns, ts, payload), F.col("mean").alias(out))


def _delay_us(stream: DataFrame, delay: str) -> int | None:
    """What the watermark stays behind the newest row, as Spark counts it; None if the stream has watermarks of its own."""
    if "EventTimeWatermark" in stream._jdf.queryExecution().analyzed().toString():
        return None
    catalyst = stream.sparkSession._jvm.org.apache.spark.sql.catalyst
    return 1000 * catalyst.plans.logical.EventTimeWatermark.getDelayMs(catalyst.util.IntervalUtils.fromIntervalString(delay))


def _by_key(rows: DataFrame, pack: Pack, processor: StatefulProcessor, shape: StructType) -> DataFrame:
    """The rows through a processor of packs, by ``key``. What leaves it is dealt out again, as keys may be few.

    It is dealt out by what a pack holds, the same whenever a task runs again: to deal it out in turns, Spark sorts it first.
    A task that writes by day sorts its rows, on disk where memory is short, so there are ``WAVES`` tasks a core.
    """
    done = rows.mapInArrow(pack, pack.schema).groupBy("key").transformWithStateInPandas(processor, processor.schema, "append", "EventTime")
    return done.repartition(WAVES * rows.sparkSession.sparkContext.defaultParallelism, AT, "rest").mapInArrow(Unpack(), shape)


def _named(columns: list[str], ts: str, payload: dict[str, str]) -> list[Column]:
    return [F.timestamp_micros(AT).alias(c) if c == ts else F.col(payload[c]).alias(c) for c in columns]


class Late(StatefulProcessor):
    """Rows whose time lies behind the watermark of their micro-batch; they come and go in packs."""

    schema = f"{AT} binary, rest binary, kept binary"

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        watermark = timerValues.getCurrentWatermarkInMs()
        for packs in rows:
            kept = [_numbers(x, np.int64) < watermark * 1000 for x in packs[AT]]
            found = packs.assign(kept=[_squeezed(x) for x in kept])[[x.any() for x in kept]]
            if len(found):
                yield found[[AT, "rest", "kept"]]

    def close(self) -> None:
        pass


def late_rows(stream: DataFrame, ts: str, delay: str = "1 hour", buckets: int = 64) -> DataFrame:
    """What ``rolling_stream`` leaves out as too old, as a stream of its own for a side table.

    The same source, batch size and ``delay`` give both queries the same watermarks. The rows are dealt over
    ``buckets`` by their content; nothing is kept between batches but the watermark.
    """
    keep_state(stream.sparkSession)
    marked = stream.where(F.col(ts).isNotNull()).withWatermark(ts, delay)
    payload = {c: f"c{i}" for i, c in enumerate(stream.columns) if c != ts}
    at, own = F.unix_micros(F.col(ts).cast("timestamp")), [F.col(f"`{c}`").alias(n) for c, n in payload.items()]
    bucket = F.pmod(F.xxhash64(at, *own), F.lit(buckets)).cast("string")
    # Without the marked column Spark does not drop late rows before they are seen.
    plain = marked.select(at.alias(AT), *own, bucket.alias("key"))
    shape = StructType([plain.schema[c] for c in (AT, *payload.values())])
    return _by_key(plain, Pack(AT), Late(), shape).select(*_named(stream.columns, ts, payload))
