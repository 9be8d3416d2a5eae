"""Keys and join-side helpers."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Window, functions as F

log = logging.getLogger(__name__)

#: a join side is broadcast up to this size, as Catalyst estimates it from files and literals
BROADCAST_BYTES = 8 << 20
#: parts of a hot key in a look-up that is too large to broadcast
SALTS = 8


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df``: file sizes and literals, no job; None where there is no plan to ask (a remote session)."""
    plan = getattr(df, "_jdf", None)
    return None if plan is None else int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` is known to take at most ``max_bytes``; nothing is run to find out."""
    size = estimated_bytes(df)
    return size is not None and size <= max_bytes


def checked_broadcast(df: DataFrame, label: str = "", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only if it is known to be small; otherwise leave the join strategy to the planner (shuffle join)."""
    if small(df, max_bytes):
        return F.broadcast(df)
    log.info("%s is not known to be small: not broadcast", label or "join side")
    return df


def lookup_join(df: DataFrame, table: DataFrame, key: str, how: str = "inner", salt_by: str | None = None,
                max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join each row of ``df`` with its one row of ``table`` on ``key``.

    A small table is broadcast.  A larger one is a shuffle join in which every key is dealt to ``SALTS`` places by
    ``salt_by`` (a column of ``df`` that differs within a key), and ``table`` is there as often, so that a key which most rows share
    isn't one task's work.
    """
    if salt_by is None or small(table, max_bytes):
        return df.join(checked_broadcast(table, key, max_bytes), key, how)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(SALTS)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


#: lengths of the prefixes by which sorted numbering counts, from coarse to fine
PREFIXES = (1, 8, 24)


def sorted_surrogate_ids(df: DataFrame, key: str, id_col: str = "id", after: int = 0) -> DataFrame:
    """Number the distinct values of string ``key`` from ``after + 1`` on in binary string order.

    A global ``row_number() OVER (ORDER BY key)`` would move every row to one task.  Here a value's number is its
    place among the values of its prefix, after all values of smaller prefixes, which are counted the same way by
    shorter prefixes.  The only unpartitioned window runs over one row for each first character.  Nothing is
    sampled or pinned: the plan is lazy, and any attempt of any task gives the same numbers.
    """
    values = df.select(key).where(F.col(key).isNotNull()).distinct()
    prefix = [F.substring(key, 1, n).alias(f"_p{n}") for n in PREFIXES]
    counts = values.groupBy(*prefix).agg(F.count(F.lit(1)).alias("_n"))
    offsets, names = None, []
    for n in PREFIXES:
        level = counts.groupBy(*names, f"_p{n}").agg(F.sum("_n").alias("_n"))
        window = (Window.partitionBy(*names) if names else Window.partitionBy()).orderBy(f"_p{n}").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_n").over(window), F.lit(0))
        if offsets is None:
            offsets = level.select(f"_p{n}", before.alias("_before"))
        else:
            own = level.select(*names, f"_p{n}", before.alias("_own"))
            offsets = own.join(offsets, names).select(*names, f"_p{n}", (F.col("_before") + F.col("_own")).alias("_before"))
        names.append(f"_p{n}")
    local = values.select(key, *prefix).withColumn("_place", F.row_number().over(Window.partitionBy(*names).orderBy(key)))
    return local.join(offsets, names).select(key, (F.col("_before") + F.col("_place") + after).cast("long").alias(id_col))
