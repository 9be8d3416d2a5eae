"""Agreement overlay on a purchase frame.

``apply_effective`` reproduces what the overlay actually changes: a
non-positive daily value becomes the default, and TOTAL is recomputed from
days x value while the two shares are left as they were.  ``apply_declared``
applies every rule the document declares: category exclusion, per-union
value, configurable split and the cap on the employee share (the excess goes
to the company), then recomputes all money.

The document is configuration: its values are read once (``load_rules``)
and applied as literals -- a literal map for the per-union values, a literal
list for the categories -- so the overlay adds no join and no subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lunchbox.functions.money import MONEY, total_value
from lunchbox.sources.rules import Rules


def _dec(v, t: str = MONEY):
    return F.lit(str(v)).cast(t)


def default_value(df: DataFrame, rules: Rules) -> DataFrame:
    """AGR1: daily value NULL or <= 0 -> the document's default value."""
    v = F.coalesce(F.col("daily_value").cast("double"), F.lit(0.0))
    return df.withColumn("daily_value", F.when(v <= 0, F.lit(rules.default_value))
                         .otherwise(v).cast(MONEY))


def exclude_categories(df: DataFrame, rules: Rules, category_col: str = "job_category") -> DataFrame:
    """AGR2: drop rows whose category is marked ``excluir`` (NULL category kept;
    no-op without the column)."""
    if category_col not in df.columns or not rules.excluded_categories:
        return df
    return df.where(~F.coalesce(F.col(category_col).isin(list(rules.excluded_categories)), F.lit(False)))


def recompute_total(df: DataFrame) -> DataFrame:
    """AGR3: TOTAL = round(days x daily value, 2)."""
    return df.withColumn("total", total_value(F.col("days"), F.col("daily_value")))


def union_value(df: DataFrame, rules: Rules) -> DataFrame:
    """AGR4: per-union daily value override, matched on the union short name."""
    if not rules.union_values:
        return df
    overrides = F.create_map(*[x for name, v in rules.union_values for x in (F.lit(name), _dec(v))])
    return df.withColumn("daily_value", F.coalesce(F.try_element_at(overrides, F.col("union_name")),
                                                   F.col("daily_value").cast(MONEY)))


def split(df: DataFrame, rules: Rules) -> DataFrame:
    """AGR5: company / employee shares from the document's percentages."""
    t = F.col("total").cast("decimal(18,2)")
    return (df.withColumn("company_cost", F.round(t * _dec(rules.company_share, "decimal(10,6)"), 2)
                          .cast("decimal(18,2)"))
            .withColumn("employee_discount", F.round(t * _dec(rules.employee_share, "decimal(10,6)"), 2)
                        .cast("decimal(18,2)")))


def cap(df: DataFrame, rules: Rules) -> DataFrame:
    """AGR6: employee share capped at ``limites.max_desconto``; excess to the company."""
    if rules.max_discount is None:
        return df
    limit = _dec(rules.max_discount, "decimal(18,2)")
    e = F.col("employee_discount").cast("decimal(18,2)")
    capped = F.least(e, limit)
    return (df.withColumn("company_cost", (F.col("company_cost") + (e - capped)).cast("decimal(18,2)"))
            .withColumn("employee_discount", capped.cast("decimal(18,2)")))


def apply_effective(df: DataFrame, rules: Rules) -> DataFrame:
    """What the overlay changes in practice: default value, then TOTAL only.

    The category rule is inert here, as it is on the sheet rows the overlay
    receives (they carry no category); ``apply_declared`` applies it.
    """
    return recompute_total(default_value(df, rules))


def apply_declared(df: DataFrame, rules: Rules) -> DataFrame:
    """Every declared rule, in order, with all money recomputed."""
    out = exclude_categories(df, rules)
    out = default_value(union_value(out, rules), rules)
    return cap(split(recompute_total(out), rules), rules)
