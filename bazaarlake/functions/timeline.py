"""Per-key timelines: trailing windows, distinct counts in trailing windows, session gaps.

Every function has two exact routes:

* ordinary keys use windows partitioned by the key: one shuffle, and work that is linear in the sorted rows;
* heavy keys use a sweep that also partitions by a time chunk, so no task holds a whole key. A trailing window is a
  running sum of arrivals (+v at t) and departures (-v just after t + width); a running sum over chunks is the sum
  inside the chunk plus the total of the chunks before it. Rows of one key and instant are combined first, so a
  chunk is bounded by its length in ticks, not by the number of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.functions.skew import routed
from bazaarlake.session import checkpointed

_FIRST = Window.unboundedPreceding
_CUBE = "decimal(38,0)"
_EARLIEST = -(1 << 63)


def _chunked(df: DataFrame, order: str, chunk: int) -> DataFrame:
    return df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk)))


def neighbours(df: DataFrame, keys: list[str], order: str, chunk: int) -> DataFrame:
    """Add `_prev` and `_next`, the neighbouring values of `order` within `keys`, partitioned by time chunk.

    `order` is different in each row of a key. The first and the last row of a chunk look for the neighbour that their
    chunk does not hold among such rows of all chunks: at most two per chunk meet in one task.
    """
    rows = _chunked(df, order, chunk)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order)
    across = Window.partitionBy(*keys).orderBy(order)
    looked = rows.withColumns({"_prev": F.lag(order).over(inside), "_next": F.lead(order).over(inside)})
    edge = F.col("_prev").isNull() | F.col("_next").isNull()
    edges = looked.filter(edge).withColumns({
        "_prev": F.coalesce("_prev", F.lag(order).over(across)), "_next": F.coalesce("_next", F.lead(order).over(across))})
    return looked.filter(~edge).unionByName(edges).drop("_chunk")


def running_sums(df: DataFrame, key: str, order: str, columns: list[str], chunk: int, wanted: str) -> DataFrame:
    """(key, order, running sums up to and including `order` within `key`) of the rows in which `wanted` is true, by time chunk.

    Rows are moved once, to their chunk; besides that only one row per chunk is moved.
    """
    rows = _chunked(df, order, chunk).repartition(key, "_chunk")
    inside = Window.partitionBy(key, "_chunk").orderBy(order).rangeBetween(_FIRST, 0)
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(_FIRST, -1)
    offsets = (
        rows.groupBy(key, "_chunk").agg(*[F.sum(c).alias(c) for c in columns], F.max(wanted).alias("_asked"))
        .select(key, "_chunk", "_asked", *[F.sum(c).over(earlier).alias(f"_base_{c}") for c in columns]).filter("_asked")
    )
    running = rows.withColumns({f"_in_{c}": F.sum(c).over(inside) for c in columns}).filter(wanted)
    return running.join(offsets, [key, "_chunk"]).select(
        key, order, *[(F.col(f"_in_{c}") + F.coalesce(f"_base_{c}", F.lit(0))).alias(c) for c in columns]
    )


def _sweep(df: DataFrame, key: str, order: str, width: int, values: dict[str, Column],
           distinct: dict[str, str], chunk: int) -> DataFrame:
    # A window without any value has no sum: how many values are there travels along.
    held = {n: f"_held_{n}" for n, v in values.items() if df.select(v).schema[0].nullable}
    ticks = df.groupBy(key, order).agg(
        *[F.coalesce(F.sum(v), F.lit(0)).alias(n) for n, v in values.items()],
        *[F.count(values[n]).alias(h) for n, h in held.items()])
    kinds = {n: ticks.schema[n].dataType for n in [*values, *held.values()]} | {n: T.LongType() for n in distinct}

    def moves(frame: DataFrame, present: dict[str, Column], arrives: Column, *ends: tuple[Column, int]) -> DataFrame:
        """`frame` at each of `ends` (time, sign) with its `present` columns, the other ones 0."""
        at = F.inline(F.array(*[F.struct(t.alias("_at"), F.lit(sign).alias("_sign")) for t, sign in ends]))
        return frame.select("*", at).select(
            key, "_at", (arrives & (F.col("_sign") == 1)).alias("_arrives"),
            *[(present[n] * F.col("_sign") if n in present else F.lit(0)).cast(kind).alias(n) for n, kind in kinds.items()])

    leaving = F.col(order) + F.lit(width + 1)
    line = moves(ticks, {n: F.col(n) for n in (*values, *held.values())}, F.lit(True), (F.col(order), 1), (leaving, -1))
    parts = []
    for name, column in distinct.items():
        # A value is present from its first sighting until `width` after the last one of an unbroken run.
        seen = df.filter(F.col(column).isNotNull()).select(key, column, order).distinct()
        runs = neighbours(seen, [key, column], order, chunk)
        opens = F.col("_prev").isNull() | (F.col(order) - F.col("_prev") > width)
        closes = F.col("_next").isNull() | (F.col("_next") - F.col(order) > width)
        ends = F.inline(F.array_compact(F.array(
            F.when(opens, F.struct(F.col(order).alias("_at"), F.lit(1).alias("_step"))),
            F.when(closes, F.struct(leaving.alias("_at"), F.lit(-1).alias("_step"))))))
        parts.append(runs.select(key, ends).select(key, "_at", *[
            (F.col("_step") if n == name else F.lit(0)).cast("bigint").alias(n) for n in distinct]))
    if parts:
        # Many values may come or go at one instant: combined first, like the rows themselves.
        # Stored, as the sums below are, so that the shuffle files of one step are gone when those of the next come.
        steps = checkpointed(reduce(DataFrame.unionByName, parts).groupBy(key, "_at").agg(*[F.sum(n).alias(n) for n in distinct]))
        line = line.unionByName(steps.select(key, "_at", F.lit(False).alias("_arrives"), *[
            (F.col(n) if n in distinct else F.lit(0)).cast(kind).alias(n) for n, kind in kinds.items()]))
    swept = running_sums(line, key, "_at", list(kinds), chunk, "_arrives")
    state = swept.select(
        key, F.col("_at").alias(order), *[F.col(n).cast("bigint").alias(n) for n in distinct],
        *[(F.when(F.col(held[n]) > 0, F.col(n)) if n in held else F.col(n)).cast(_CUBE).alias(n) for n in values]
    )
    return df.join(checkpointed(state), [key, order])


def _running(df: DataFrame, key: str, order: str, width: int, values: dict[str, Column],
             distinct: dict[str, str], lies: str | None = None) -> DataFrame:
    """The same sums for keys that fit one task: one shuffle on the key and work that is linear in its sorted rows.

    A window is what has arrived up to `order` less what had arrived before `order - width`. Both are running sums over
    rows in one order, so no row is doubled or summed once per window. Rows without `order` come first and see each other.
    The key stays the column by which the rows lie, so a second window on it needs no shuffle of its own. `lies` names a
    column by which the rows lie already and of which a key has one value: the windows then stay where the rows are.
    """
    at, missing = F.col(order), F.col(order).isNull()
    if dict(df.dtypes)[order] != "bigint":  # a plain column lets windows on the same key and column share one sort
        at = at.cast("bigint")
    mark = "_w"  # helpers beside the caller's columns start like none of these
    while any(c.startswith(mark) for c in df.columns):
        mark += "_"
    # Without this the first window below would spread the rows by key and value, and the next ones anew by key.
    rows = df.repartition(key) if distinct and lies is None else df
    whole = [key] if lies in (None, key) else [lies, key]
    for name, column in distinct.items():
        # A value is present from its first sighting until `width` after the last one of an unbroken run.
        same = Window.partitionBy(*whole, column).orderBy(order)  # rows without `order` first
        opens = F.when(missing, F.row_number().over(same) == 1).otherwise(
            F.coalesce(F.col(order) - F.lag(order).over(same) > width, F.lit(True)))
        closes = F.when(missing, opens).otherwise(
            F.coalesce(F.lead(order).over(same) - F.col(order) > width, F.lit(True)))
        seen = F.col(column).isNotNull()
        rows = rows.withColumns({f"{mark}opens_{name}": (seen & opens).cast("bigint"),
                                 f"{mark}closes_{name}": (seen & closes).cast("bigint")})
    along = Window.partitionBy(*whole).orderBy(at)
    arrived, left = along.rangeBetween(_FIRST, 0), along.rangeBetween(_FIRST, -(width + 1))

    def inside(comes: Column, goes: Column) -> Column:
        gone = F.when(missing, 0).otherwise(F.coalesce(F.sum(goes).over(left), F.lit(0)))
        return F.coalesce(F.sum(comes).over(arrived), F.lit(0)) - gone

    # A window without any value has no sum: how many values are there is counted beside it.
    held = {n: f"{mark}held_{n}" for n, v in values.items() if df.select(v).schema[0].nullable}
    there = {n: F.when(values[n].isNotNull(), 1).otherwise(0) for n in held}
    state = rows.withColumns({
        **{f"{mark}sum_{n}": inside(v, v) for n, v in values.items()},
        **{held[n]: inside(t, t) for n, t in there.items()},
        **{f"{mark}sum_{n}": inside(F.col(f"{mark}opens_{n}"), F.col(f"{mark}closes_{n}")) for n in distinct}})
    sums = {n: F.when(F.col(held[n]) > 0, F.col(f"{mark}sum_{n}")) if n in held else F.col(f"{mark}sum_{n}") for n in values}
    kept = [c for c in df.columns if c not in values and c not in distinct]
    return state.select(*kept, *[s.cast(_CUBE).alias(n) for n, s in sums.items()],
                        *[F.col(f"{mark}sum_{n}").cast("bigint").alias(n) for n in distinct])


def trailing(df: DataFrame, key: str, order: str, width: int, values: dict[str, Column],
             distinct: dict[str, str] | None = None, chunk: int = 86_400, lies: str | None = None,
             **routing) -> DataFrame:
    """Add exact trailing sums and distinct counts over [order - width, order] within `key`.

    `values` maps an output name to a whole-number column to sum (`F.lit(1)` counts); `distinct` maps an output
    name to the column whose different values are counted. `order` is a whole number (seconds or microseconds).
    `lies` may name a column by which the rows lie already and of which each key has one value. `routing` goes to
    `skew.routed`.
    """
    distinct = distinct or {}
    return routed(df, key, lambda rows: _running(rows, key, order, width, values, distinct, lies),
                  lambda rows: _sweep(rows, key, order, width, values, distinct, chunk), order=order, **routing)


def _sessions_plain(df: DataFrame, key: str, order: str, gap: int) -> DataFrame:
    ordered = Window.partitionBy(key).orderBy(order)
    opened = F.when(F.coalesce(F.col(order) - F.lag(order).over(ordered) > gap, F.lit(True)), F.col(order))
    return df.withColumn("_opened", opened).withColumn(
        "session_open", F.max("_opened").over(ordered.rangeBetween(_FIRST, 0))
    ).drop("_opened")


def _sessions_chunked(df: DataFrame, key: str, order: str, gap: int, chunk: int) -> DataFrame:
    ticks = neighbours(df.select(key, order).distinct(), [key], order, chunk)
    opened = F.when(F.col("_prev").isNull() | (F.col(order) - F.col("_prev") > gap), F.col(order))
    marked = _chunked(ticks.select(key, order, opened.alias("_opened")), order, chunk)
    inside = Window.partitionBy(key, "_chunk").orderBy(order).rangeBetween(_FIRST, 0)
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(_FIRST, -1)
    carried = (
        marked.groupBy(key, "_chunk").agg(F.max("_opened").alias("_last"))
        .select(key, "_chunk", F.max("_last").over(earlier).alias("_carried"))
    )
    state = (
        marked.withColumn("_own", F.max("_opened").over(inside)).join(carried, [key, "_chunk"])
        .select(key, order, F.coalesce("_own", "_carried").alias("session_open"))
    )
    return df.join(state, [key, order])


def gap_sessions(df: DataFrame, key: str, order: str, gap: int, chunk: int | None = None, **routing) -> DataFrame:
    """Add `session_open`, the `order` value that opened the row's session; a pause above `gap` opens a new one."""
    return routed(df, key, lambda rows: _sessions_plain(rows, key, order, gap),
                  lambda rows: _sessions_chunked(rows, key, order, gap, chunk or 48 * gap), order=order, **routing)


def previous(df: DataFrame, key: str, order: str, tie: str, value: str, name: str, chunk: int,
             **routing) -> DataFrame:
    """Add `value` of the row before in (`order`, `tie`) within `key`.

    On the heavy route a row looks back inside its time chunk, and the first row of a chunk takes the last value of
    the chunk before.
    """
    at = F.struct(order, tie)

    def plain(frame: DataFrame, *parts: str) -> DataFrame:
        return frame.withColumn(name, F.lag(value).over(Window.partitionBy(key, *parts).orderBy(order, tie)))

    def heavy(frame: DataFrame) -> DataFrame:
        rows = _chunked(frame, order, chunk)
        ends = rows.groupBy(key, "_chunk").agg(F.max_by(F.struct(value), at).alias("_last"), F.min(at).alias("_first"))
        across = Window.partitionBy(key).orderBy("_chunk")
        ends = ends.select(key, "_chunk", "_first", F.lag("_last").over(across)[value].alias("_carried"))
        looked = plain(rows, "_chunk").alias("l")  # rows without time are a chunk of their own, the first
        joined = looked.join(ends.alias("r"), (F.col(f"l.{key}") == F.col(f"r.{key}")) & F.col("l._chunk").eqNullSafe(F.col("r._chunk")))
        opens = F.col("_first").eqNullSafe(F.struct(F.col(f"l.{order}").alias(order), F.col(f"l.{tie}").alias(tie)))
        return joined.select(*[F.col(f"l.{c}") for c in frame.columns if c != name],
                             F.when(opens, F.col("_carried")).otherwise(F.col(f"l.{name}")).alias(name))

    return routed(df, key, plain, heavy, **routing)
