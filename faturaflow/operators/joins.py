"""Equi-joins to tables with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROUTE = "__route"
#: A route has twelve bits, as it is shuffled with every row. Masked, it is never NULL for Catalyst, which
#: would otherwise filter one use of a directory and not another, and then compute both.
_ROUTE_BITS = (1 << 12) - 1


def _route(keys: Sequence[str], spread: Column | None) -> Column:
    cols = [F.col(k) for k in keys]
    hashed = F.xxhash64(*cols)
    if spread is not None:
        has_null = F.lit(False)
        for c in cols:
            has_null = has_null | c.isNull()
        hashed = F.when(has_null, F.xxhash64(spread)).otherwise(hashed)
    return hashed.bitwiseAND(F.lit(_ROUTE_BITS)).cast("int")


def lookup_join(
    facts: DataFrame,
    directory: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    spread_by: str | None = None,
) -> DataFrame:
    """Join `facts` to `directory`, which has one row per `keys`.

    There is no broadcast hint: Spark broadcasts the directory only when its own
    statistics, or the size AQE measures at run time, are under the session's
    broadcast threshold. Beyond that it is a sort-merge join, and AQE's skew join
    splits a hot key on the facts side.

    AQE can split a partition only where the join has its own exchange on both
    sides. A directory is usually an aggregate already partitioned by the key, so
    its exchange would be shared; the added hash key gives the join an exchange of
    its own. On the facts side that hash also spreads rows whose key is NULL (which
    never match) by `spread_by`, instead of sending all of them to one task.
    """
    spread = F.col(spread_by) if spread_by else None
    left = facts.withColumn(_ROUTE, _route(keys, spread))
    right = directory.withColumn(_ROUTE, _route(keys, None))
    return left.join(right, [*keys, _ROUTE], how).drop(_ROUTE)
