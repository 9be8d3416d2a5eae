"""End-to-end runs, as a user calls them.

* ``generate_purchase``: purchase rows and validation totals for periods
  (the stand-alone generator; shares fixed at 80/20).
* ``process_benefits``: purchase, then the agreement overlay, then the export
  guard and the sheet write (the orchestrated run).

Both build one lazy plan per output; the writes are the only actions.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, functions as F

from lunchbox.operators import agreement, calc, reports
from lunchbox.periods import Period
from lunchbox.sources import sinks
from lunchbox.sources.model import HRModel
from lunchbox.sources.rules import load_rules

log = logging.getLogger(__name__)


def generate_purchase(model: HRModel, periods: list[Period] | None = None) -> tuple[DataFrame, DataFrame]:
    """(layout, validation totals) for the periods (default: the model's period)."""
    c = calc.purchase_calc(model, periods)
    return calc.layout(c, with_period=True), reports.validation_totals(c)


def apply_agreement(model: HRModel, rules_source: str, periods: list[Period] | None = None,
                    declared: bool = False, with_period: bool = False) -> DataFrame:
    """Purchase rows with the agreement overlay applied, in layout form."""
    c = calc.purchase_calc(model, periods)
    rules = load_rules(model.spark, rules_source)
    overlay = agreement.apply_declared if declared else agreement.apply_effective
    out = overlay(c, rules)
    return calc.layout(out, with_period)


def process_benefits(model: HRModel, rules_source: str, output: str,
                     periods: list[Period] | None = None, fmt: str = "csv",
                     declared: bool = False) -> str:
    """Compute, apply the agreement, guard and write the purchase sheet.

    An empty result is still written (with a warning); partitions of other
    periods already in ``output`` are left untouched.
    """
    layout = apply_agreement(model, rules_source, periods, declared, with_period=True)
    rows = Observation()  # counted by the write itself
    sinks.write_purchase_sheet(layout.observe(rows, F.count(F.lit(1)).alias("n")), output, fmt)
    if rows.get["n"] == 0:
        log.warning("purchase is empty for %s", [p.label for p in periods or [model.period]])
    return output
