"""SQL ``IN`` / ``NOT IN`` against a subquery, as joins that scale.

``x IN (S)``  keeps rows whose non-NULL key occurs in S: a left semi join.
``x NOT IN (S)`` has three-valued logic: it is TRUE for every row when S is
empty; otherwise a NULL ``x`` or any NULL in S makes it NULL (row dropped).

Spark plans ``NOT IN`` as a null-aware anti join only while S fits a
broadcast; beyond that it degrades to a nested-loop join.  Here the anti join
is a plain equi anti join on the distinct non-NULL keys of S (broadcast or
sort-merge, chosen by AQE from runtime sizes, skewed partitions split), and
the two NULL rules are scalar subqueries (one aggregate over S, evaluated once).
Keys of S are de-duplicated first, so a key repeated in a third of S shrinks
to one row before any shuffle of the probe side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retally.operators.bitmaps import probed


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def planned_bytes(df: DataFrame) -> int:
    """The planner's size estimate of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner would broadcast ``df`` by its estimate (never with broadcasts switched off)."""
    return planned_bytes(df) <= broadcast_limit(df)


def distinct_keys(sub: DataFrame, key: Column | str, name: str) -> DataFrame:
    """Distinct non-NULL keys of ``sub`` in one column ``name``."""
    return sub.select(_col(key).alias(name)).where(F.col(name).isNotNull()).distinct()


def is_in(df: DataFrame, key: Column | str, sub: DataFrame, sub_key: Column | str, in_place: bool = False,
          bitmaps: DataFrame | None = None) -> DataFrame:
    """``df WHERE key IN (SELECT sub_key FROM sub)``; with ``bitmaps`` of the keys, these are probed instead.

    Catalyst moves a semi join below a Generate or into the branches of a
    union; ``in_place`` keeps it where it stands (an inner join with the
    distinct keys is the same rows).
    """
    if bitmaps is not None:
        return probed(df, _col(key), bitmaps, member=True)
    keys = distinct_keys(sub, sub_key, "__in_key")
    if in_place:
        return df.join(keys, _col(key) == F.col("__in_key")).drop("__in_key")
    return df.join(keys, _col(key) == F.col("__in_key"), "left_semi")


def not_in(df: DataFrame, key: Column | str, sub: DataFrame, sub_key: Column | str, in_place: bool = False,
           bitmaps: DataFrame | None = None) -> DataFrame:
    """``df WHERE key NOT IN (SELECT sub_key FROM sub)`` with SQL NULL semantics.

    ``in_place``: as an outer join with a NULL test, which is not moved below a Generate.
    With ``bitmaps`` of the non-NULL keys, these are probed instead.
    """
    probe = _col(key)
    values = sub.select(_col(sub_key).alias("__nin_key"))
    n_all = values.agg(F.count(F.lit(1))).scalar()
    n_null = values.agg(F.count_if(F.col("__nin_key").isNull())).scalar()
    keys = values.where(F.col("__nin_key").isNotNull()).distinct()
    if bitmaps is not None:
        kept = probed(df, probe, bitmaps, member=False)
    elif in_place:
        kept = df.join(keys, probe == F.col("__nin_key"), "left").where(F.col("__nin_key").isNull()).drop("__nin_key")
    else:
        kept = df.join(keys, probe == F.col("__nin_key"), "left_anti")
    return kept.where((n_all == 0) | (probe.isNotNull() & (n_null == 0)))
