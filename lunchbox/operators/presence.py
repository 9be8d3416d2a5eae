"""Key presence: which sources hold a key, and how many of their rows do.

References between any number of tables are checked by one aggregation: every table sends (domain, key, source)
rows, a key's sources are counted in one row, and a second, tiny aggregation adds up the rows of each source whose
key is (or isn't) held by the domain's own table.  A key that holds a third of all rows sends one row a task, as the
counts are partial before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: the source that holds a domain's keys
OWNER = -1


def keyed(df: DataFrame, key: str | Column, source: int, domain: int = 0, **flags: Column) -> DataFrame:
    """Rows of one source; ``flags``: further boolean columns."""
    own = F.col(key) if isinstance(key, str) else key
    return df.select(F.lit(domain).cast("byte").alias("domain"), own.cast("long").alias("key"), F.lit(source).cast("byte").alias("source"),
                     *(c.alias(n) for n, c in flags.items()))


def presence(rows: list[DataFrame], sources: int, flags: tuple[str, ...] = ()) -> DataFrame:
    """A row for each key: ``owned`` (the domain's table holds it), ``n0`` .. the rows of each source, and whether the owner has each flag."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return every.groupBy("domain", "key").agg(
        F.count_if(F.col("source") == OWNER).alias("owners"),
        *[F.count_if(F.col("source") == s).alias(f"n{s}") for s in range(sources)],
        *[F.count_if(F.col(f) & (F.col("source") == OWNER)).alias(f) for f in flags])


def stacked(totals: DataFrame, labels: list[str], columns: list[str], key: str, value: str) -> DataFrame:
    """One row of totals in long form, in the order of the labels."""
    args = ", ".join(f"'{label}', CAST(COALESCE({c}, 0) AS BIGINT)" for label, c in zip(labels, columns))
    return totals.selectExpr(f"stack({len(labels)}, {args}) AS (`{key}`, `{value}`)")


def orphans(rows: list[DataFrame], labels: list[str], key: str = "check", value: str = "offenders") -> DataFrame:
    """For each source its rows whose key the domain's table doesn't hold (a NULL key is held by none)."""
    held = presence(rows, len(labels))
    lost = (F.col("owners") == 0) | F.col("key").isNull()
    totals = held.agg(*[F.sum(F.when(lost, F.col(f"n{s}"))).alias(f"n{s}") for s in range(len(labels))])
    return stacked(totals, labels, [f"n{s}" for s in range(len(labels))], key, value)
