"""Rows in order of (key, time): what came before a row of its key, without a window over the key.

Rows are dealt into ranges of (key, time) and sorted there, so a key with a third of all rows fills as many ranges as it needs. One pass
over a range carries the last state along: a state is a row that others look back to. What a range's first rows look back to lies in an
earlier range; these rows are marked, each range tells the last state it saw, and one broadcast of a row for each range completes them. No row
is held but the last state, and no key is gathered.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from envflow.shared import written

_PART, _PENDING, _END = "__part", "__pending", "__end"


def _changes(columns: list[pa.Array], n: int) -> np.ndarray:
    """Whether each row but the first differs from the one before in a column; null is like null."""
    out = np.zeros(n, dtype=bool)
    for c in columns:
        a, b = c.slice(1), c.slice(0, n - 1)
        equal = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        out[1:] |= ~equal.to_numpy(zero_copy_only=False)
    return out


def _look_back(keys: Sequence[str], states: Sequence[str], inclusive: bool):
    """Adds to each row of a sorted range the columns of the last state of its key, as before_<column>.

    __pending: the row's key is the range's first and no state of it has been seen here. __end: the last state of the range (in its
    last row), as a struct; null where there was none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held: pa.RecordBatch | None = None  # the last row, and the last state as its row
        state: pa.RecordBatch | None = None
        first_key, last, waiting = True, None, None

        def finished(batch: pa.RecordBatch | None, end: bool) -> Iterator[pa.RecordBatch]:
            """A batch with the range's last state in its last row, if it is the range's last."""
            if batch is not None:
                told = list(dict.fromkeys((*keys, *states)))
                at = pa.array([None] * (len(batch) - 1) + [0 if end and state is not None else None], pa.int32())
                values = [(state if state is not None else batch).column(c).take(at) for c in told]
                ends = pa.StructArray.from_arrays(values, fields=[pa.field(c, v.type) for c, v in zip(told, values, strict=True)], mask=at.is_null())
                yield batch.append_column(_END, ends)

        for batch in batches:
            n = len(batch)
            if not n:
                continue
            yield from finished(waiting, False)
            columns = [batch.column(k) for k in keys]
            new_key = _changes(columns, n)
            if last is not None:
                new_key[0] = any(last.column(k)[0].as_py() != batch.column(k)[0].as_py() for k in keys)
            begins = np.flatnonzero(new_key)
            at = np.arange(n)
            key_start = np.maximum.accumulate(np.where(new_key, at, -1))  # -1: the key of the row before this batch
            is_state = batch.column("__state").to_numpy(zero_copy_only=False).astype(bool)
            seen = np.maximum.accumulate(np.where(is_state, at, -1))
            if not inclusive:
                seen = np.concatenate(([-1], seen[:-1]))
            own = (seen >= 0) & (seen >= key_start)
            from_before = ~own & (key_start < 0) & (state is not None)
            if state is not None and from_before.any():
                from_before &= all(state.column(k)[0].as_py() == batch.column(k)[0].as_py() for k in keys)
            pending = ~own & ~from_before & (key_start < 0) & first_key
            take = pa.array(np.where(own, seen, n), mask=~(own | from_before))
            found = [(batch.column(c) if state is None else pa.concat_arrays([batch.column(c), state.column(c)])).take(take) for c in states]
            names = [c for c in batch.schema.names if c != "__state"]
            waiting = pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *found, pa.repeat(pa.scalar(part, pa.int32()), n), pa.array(pending)],
                names=[*names, *(f"before_{c}" for c in states), _PART, _PENDING],
            )
            first_key = first_key and not len(begins)
            some = np.flatnonzero(is_state)
            if len(some):
                state = batch.take(pa.array(some[-1:]))
            last = batch.take(pa.array([n - 1]))
        yield from finished(waiting, True)

    return run


def look_back(df: DataFrame, keys: Sequence[str], order: Sequence[str], states: Sequence[str], state: Column | None = None, inclusive: bool = False) -> DataFrame:
    """df with before_<column>, for each of the columns states, of the last earlier row of the same keys where state holds (of any row without it).

    order, in which nulls come first, tells which rows are earlier; rows that are alike in keys and order come in any order. With inclusive a
    row may be its own state. Null keys are a key of their own. before_<column> is null where there is no earlier state. Names that
    begin with two underscores are the function's own.
    """
    rows = df.withColumn("__state", F.coalesce(state, F.lit(False)) if state is not None else F.lit(True)).withColumn("__row", F.monotonically_increasing_id())
    by = [*keys, *order]
    ranged = rows.repartitionByRange(*by, "__row").sortWithinPartitions(*by).drop("__row")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    end = T.StructType([T.StructField(c, kinds[c]) for c in dict.fromkeys((*keys, *states))])
    schema = T.StructType([*df.schema.fields, *(T.StructField(f"before_{c}", kinds[c]) for c in states), T.StructField(_PART, T.IntegerType()), T.StructField(_PENDING, T.BooleanType()), T.StructField(_END, end)])
    passed = written(ranged.mapInArrow(_look_back(list(keys), list(states), inclusive), schema), "look_back")
    # a row for each range: the last state before it
    ends = passed.groupBy(_PART).agg(F.first(_END, ignorenulls=True).alias("__end"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(_PART, F.last("__end", ignorenulls=True).over(earlier).alias("__carried"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"__carried.{k}").eqNullSafe(F.col(k))
    use = F.col(_PENDING) & F.col("__carried").isNotNull() & same
    out = passed.join(F.broadcast(carried), _PART, "left")
    return out.select(*df.columns, *(F.when(use, F.col(f"__carried.{c}")).otherwise(F.col(f"before_{c}")).alias(f"before_{c}") for c in states))


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], time_left: str, time_right: str, tie_left: str | None = None, tie_right: str | None = None, allow_equal: bool = True) -> DataFrame:
    """Each row of left with the columns of the newest row of right of the same keys that isn't later; nulls where there is none.

    Both sides are merged into one table of ranges of (keys, time), so no key is gathered and nothing is compared with an inequality.
    Rows of right without a time never count. Of rows of right at the same time the one with the largest tie counts. Without allow_equal, or with a tie_left that is not larger
    than the other's tie, a row of right at the very time does not count. Columns other than keys have different names in left and right.
    """
    own, theirs = [c for c in left.columns if c not in keys], [c for c in right.columns if c not in keys]
    side = 1 if allow_equal else -1  # at equal times rows of right come first, or last

    def merged(df: DataFrame, is_right: bool) -> DataFrame:
        kinds = left.schema if is_right else right.schema
        others = own if is_right else theirs
        time, tie = (time_right, tie_right) if is_right else (time_left, tie_left)
        nulls = {c: F.lit(None).cast(kinds[c].dataType) for c in others}
        ties = F.col(tie).cast("bigint") if tie else F.lit(0).cast("bigint")
        compared = tie_left is not None and tie_right is not None
        rank = {"__time": F.col(time), "__first": ties if compared else F.lit(-side if is_right else side).cast("bigint"), "__second": F.lit(-side if is_right else side) if compared else F.lit(0), "__third": ties}
        return df.withColumns(nulls | rank | {"__right": F.lit(is_right)})

    both = merged(left, False).unionByName(merged(right, True))
    found = look_back(both, keys, ["__time", "__first", "__second", "__third"], theirs, F.col("__right") & F.col("__time").isNotNull())
    return found.where("NOT __right").select(*left.columns, *(F.col(f"before_{c}").alias(c) for c in theirs))


def counter_rate(df: DataFrame, keys: Sequence[str], time: str, total: str, tie: str) -> DataFrame:
    """Adds rate: the growth of a cumulative counter per second since the sample before, 0 for the first and for falls."""
    back = look_back(df, keys, [time, tie], [time, total])
    return back.select(*df.columns, _rate(time, total, _seconds(F.col(f"before_{time}")), F.col(f"before_{total}")).alias("rate"))


def _seconds(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp")) / F.lit(1e6)


def _rate(time: str, total: str, seconds_before: Column, total_before: Column) -> Column:
    rate = F.greatest((F.col(total) - total_before) / F.greatest(_seconds(F.col(time)) - seconds_before, F.lit(1e-6)), F.lit(0.0))
    return F.round(F.coalesce(rate, F.lit(0.0)), 3)


def stream_counter_rate(stream: DataFrame, key: str, time: str, total: str, tie: str, delay: str = "1 hour", keep_hours: int = 24) -> DataFrame:
    """counter_rate of a stream: a key's last sample is its state, and goes keep_hours after it where no other has come.

    time is a timestamp. A sample that is older than the state (and not so late that the watermark of delay drops it) has rate 0 and leaves the state as it is.
    A sample without a time has rate 0 and is no state. What is done for a key is done on arrays, as there may be very many keys of few samples.
    A task holds a key's samples of one micro-batch, so batches are kept small where a key is hot (files_per_batch).
    """
    columns = stream.columns
    timed = stream.withWatermark(time, delay).withColumns({"__us": F.unix_micros(time), "__total": F.col(total).cast("double"), "__tie": F.col(tie)})

    def run(_, frames, state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        frames = list(frames)
        frame = frames[0] if len(frames) == 1 else pd.concat(frames)
        us, ties = frame["__us"].to_numpy(), frame["__tie"].to_numpy()
        if ties.dtype.kind not in "iuf":
            frame = frame.sort_values(["__us", "__tie"], kind="stable")
        elif ((order := np.lexsort((ties, us)))[1:] < order[:-1]).any():
            frame = frame.iloc[order]
        us, totals, n = frame["__us"].to_numpy(), frame["__total"].to_numpy(), len(frame)
        n_timed = n - int(np.isnan(us).sum()) if us.dtype.kind == "f" else n  # rows without a time come last
        last = state.get if state.exists else None
        first = int(np.searchsorted(us[:n_timed], last[0])) if last else 0
        before_us, before_total, none = np.zeros(n, dtype=np.int64), np.full(n, np.nan), np.ones(n, dtype=bool)
        if first < n_timed:
            later, earlier = slice(first + 1, n_timed), slice(first, n_timed - 1)
            before_us[later], before_total[later], none[later] = us[earlier], totals[earlier], False
            if last:
                before_us[first], before_total[first], none[first] = last[0], np.nan if last[1] is None else last[1], False
            total_now = float(totals[n_timed - 1])
            last = (int(us[n_timed - 1]), None if np.isnan(total_now) else total_now)
        if last:
            state.update(last)
            state.setTimeoutTimestamp(max(last[0] // 1000 + keep_hours * 3_600_000, state.getCurrentWatermarkMs() + 1))
        frame = frame.copy(deep=False)
        frame["__before_us"], frame["__before_total"] = pd.arrays.IntegerArray(before_us, none), before_total
        yield frame

    schema = T.StructType([*timed.schema.fields, T.StructField("__before_us", T.LongType()), T.StructField("__before_total", T.DoubleType())])
    back = timed.groupBy(key).applyInPandasWithState(run, schema, "us BIGINT, total DOUBLE", "append", GroupStateTimeout.EventTimeTimeout)
    return back.select(*columns, _rate(time, total, F.col("__before_us") / F.lit(1e6), F.col("__before_total")).alias("rate"))


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "n") -> DataFrame:
    """Adds name: the place of a row among those of its keys by order, from 1.

    Ranges number their rows. A key that spans ranges begins in each with what the ranges before hold of it: a sum over two rows
    for each range, of its first key and of its last.
    """
    by = [*keys, *order]
    ranged = df.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*by, "__row").sortWithinPartitions(*by).drop("__row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, count, first = TaskContext.get().partitionId(), None, 0, True
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            new = _changes([batch.column(k) for k in keys], n)
            if last is not None:
                new[0] = any(last.column(k)[0].as_py() != batch.column(k)[0].as_py() for k in keys)
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, -1))
            place = np.where(start < 0, count + at + 1, at - start + 1)
            begins = np.flatnonzero(new)
            first_key = np.full(n, first) if not len(begins) else first & (at < begins[0])
            first, count = first and not len(begins), int(place[-1])
            last = batch.take(pa.array([n - 1]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64()), pa.repeat(pa.scalar(part, pa.int32()), n), pa.array(first_key)], names=[*batch.schema.names, name, _PART, "__first"])

    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType()), T.StructField(_PART, T.IntegerType()), T.StructField("__first", T.BooleanType())])
    passed = written(ranged.mapInArrow(run, schema), "running")
    key = F.struct(*keys).alias("__key")
    last = passed.groupBy(_PART).agg(F.max_by(F.struct(key, F.col(name).alias("__n")), F.struct(*by, name)).alias("__last"))
    ends = passed.where("__first").select(_PART, key, F.lit(0).alias("__kind"), F.lit(0).cast("bigint").alias("__n")).distinct()
    ends = ends.unionByName(last.select(_PART, F.col("__last.__key").alias("__key"), F.lit(1).alias("__kind"), F.col("__last.__n").alias("__n")))
    earlier = Window.partitionBy("__key").orderBy(_PART, "__kind").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.withColumn("__before", F.sum("__n").over(earlier)).where("__kind = 0").select(_PART, "__before")
    out = passed.join(F.broadcast(before), _PART, "left")
    return out.select(*df.columns, (F.col(name) + F.when(F.col("__first"), F.coalesce("__before", F.lit(0))).otherwise(0)).alias(name))

