"""lunchbox: meal-voucher benefit calculation as Spark DataFrame plans.

Every operator is a ``DataFrame -> DataFrame`` transformation over the
normalised HR model (:class:`lunchbox.sources.model.HRModel`).  Nothing is
collected to the driver; the only actions are the caller's.

Typical use::

    from lunchbox import Period, read_model, purchase_calc, monthly_purchase, process_benefits
    model = read_model(spark, "s3://bucket/hr/model", Period.parse("2025-04-15", "2025-05-15"))
    monthly_purchase(model).write.parquet(...)
    process_benefits(model, "rules.json", "s3://bucket/hr/purchase")
"""

from lunchbox.periods import Period
from lunchbox.operators.calc import monthly_purchase, purchase_calc
from lunchbox.plans.benefits import apply_agreement, generate_purchase, process_benefits
from lunchbox.sources.model import HRModel
from lunchbox.sources.tables import read_model, write_model

__all__ = ["Period", "HRModel", "read_model", "write_model", "purchase_calc", "monthly_purchase",
           "generate_purchase", "apply_agreement", "process_benefits"]
