"""Finding keys that are too heavy for one task.

Operators that order rows inside a key (trailing windows, session gaps) send each key to one task. They ask here
which keys hold too many rows and route those rows through an algorithm that also splits them by time. The answer
changes only the route, never the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.session import checkpointed

HOT_ROWS = 2_000_000
BROADCAST_KEYS = 200_000
ALL = "all"


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS, rows: str | None = None) -> DataFrame | list:
    """All keys with more than `min_rows` rows, as a stored frame, or `[]` if there are none; a stream has none.

    One column is scanned and counted with map-side combine. The keys stay in Spark. Callers with several windows on
    one key search once, on the narrowest table that holds at least their rows, and hand the answer to each. `rows` names
    a column that says for how many rows a row stands.
    """
    if df.isStreaming:
        return []
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg((F.sum(rows) if rows else F.count(F.lit(1))).alias("_rows"))
    found = checkpointed(counted.filter(F.col("_rows") > min_rows).select(key))
    return [] if found.isEmpty() else found


def none_hot(hot: DataFrame | list | str) -> bool:
    return hot.isEmpty() if isinstance(hot, DataFrame) else not hot


def cut(df: DataFrame, key: str, hot: DataFrame | list | str, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(ordinary rows, heavy rows). Rows without key are ordinary, and so are rows without `order` if it is given.

    The keys are broadcast only if they are few.
    """
    if isinstance(hot, str):
        marked = df.withColumn("_hot", F.col(key).isNotNull())
    elif isinstance(hot, DataFrame):
        keys = hot.select(key, F.lit(True).alias("_hot"))
        marked = df.join(F.broadcast(keys) if hot.count() <= BROADCAST_KEYS else keys, key, "left")
    else:
        marked = df.withColumn("_hot", F.col(key).isin(hot))
    chosen = F.coalesce("_hot", F.lit(False))
    if order is not None:
        chosen = chosen & F.col(order).isNotNull()
    return marked.filter(~chosen).select(*df.columns), marked.filter(chosen).select(*df.columns)


def routed(df: DataFrame, key: str, plain: Callable[[DataFrame], DataFrame],
           heavy: Callable[[DataFrame], DataFrame], min_rows: int = HOT_ROWS,
           hot: DataFrame | list | str | None = None, order: str | None = None) -> DataFrame:
    """Rows of ordinary keys through `plain`, rows of heavy keys through `heavy`.

    `hot` gives the heavy keys, `ALL` sends every row with a key the heavy way, None searches. Rows without key always
    go the plain way, and with `order` so do rows whose `order` is NULL: they see only each other. The heavy route
    reads its rows several times, so they are checkpointed first; with `ALL` they are all rows, and what is left for the
    plain way is read from there as well.
    """
    keys = hot_keys(df.select(key), key, min_rows) if hot is None else hot
    if none_hot(keys):
        return plain(df)
    if isinstance(keys, str):
        light, rows = cut(checkpointed(df), key, keys, order)
        return plain(light).unionByName(heavy(rows))
    light, rows = cut(df, key, keys, order)
    return plain(light).unionByName(heavy(checkpointed(rows)))
