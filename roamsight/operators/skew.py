"""Joins in which one key may hold a large share of the rows.

Both joins take the hot keys found by :func:`hot_keys`. The list comes from exact counts and is fixed before the join is
planned, so a task that runs again sees the same list. The result never depends on which keys are listed: a hot key
only takes another route to the same rows. Without hot keys the joins are plain ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamsight.params import Skew
from roamsight.sources.staging import Keep, measured

_SLICE = "_slice"
_SLICES = "_slices"


def hot_keys(
    weights: DataFrame, key: str, weight: str, skew: Skew, keep: Keep = measured, total: int | None = None
) -> DataFrame | None:
    """Keys with more rows than the target and the number of slices to cut each into; None if there are none.

    ``weights`` has one row per key, and ``total`` is the sum of the weights where the caller knows it. The stored list has
    fewer than ``skew.max_keys`` rows, see :class:`Skew`.
    """
    if total is None:
        total = weights.agg(F.sum(weight)).first()[0] or 0
    target = F.lit(max(skew.target_rows, -(-total // skew.max_keys))).cast("bigint")
    found = weights.where(F.col(weight) > target).select(key, F.ceil(F.col(weight) / target).cast("int").alias(_SLICES))
    found, size = keep(found, "hot_keys", keys=F.count(F.lit(1)))
    return found if size["keys"] else None


def join_sliced(facts: DataFrame, dim: DataFrame, key: str, row_id: str, hot: DataFrame | None, how: str) -> DataFrame:
    """Join on ``key`` with each hot key cut into slices.

    Fact rows of a hot key go to a slice by the hash of ``row_id``, which must differ between them and stay the same
    when a task runs again; the key's dimension row is repeated once per slice. All other keys have a single slice. In
    total two dimension rows per ``target_rows`` fact rows are added at most. Without hot keys ``row_id`` is not used.
    """
    if hot is None:
        return facts.join(dim, key, how)
    slices = F.coalesce(F.col(_SLICES), F.lit(1))
    sliced_facts = facts.join(F.broadcast(hot), key, "left").withColumn(
        _SLICE, F.pmod(F.xxhash64(F.col(row_id)), slices).cast("int")
    )
    sliced_dim = dim.join(F.broadcast(hot), key, "left").withColumn(
        _SLICE, F.explode(F.sequence(F.lit(0), slices - 1))
    )
    return sliced_facts.drop(_SLICES).join(sliced_dim.drop(_SLICES), [key, _SLICE], how).drop(_SLICE)


def join_split(
    facts: DataFrame, dim: DataFrame, key: str, row_id: str, hot: DataFrame | None, number: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Add the columns of ``dim`` to facts whose key is often NULL.

    Rows with a NULL key are kept with empty columns; rows with a key that ``dim`` lacks are dropped.
    NULL keys never reach a shuffle, and hot keys are cut into slices. ``number`` adds ``row_id`` to each part, after
    the split, so that the conditions on the key still reach the scan.
    """
    with_key = number(facts.where(F.col(key).isNotNull()))
    without = number(facts.where(F.col(key).isNull()))
    return join_sliced(with_key, dim, key, row_id, hot, "inner").unionByName(without, allowMissingColumns=True)
