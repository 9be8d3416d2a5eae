"""Collective-agreement rules document (JSON), read with a fixed schema.

The document is configuration: one small JSON object, inline text or a file
(any path Spark can read).  ``read_rules`` parses it with the fixed schema
into a one-row DataFrame; ``load_rules`` takes that single row once and
returns the values as a :class:`Rules` object, which the agreement operators
apply as literals (no subquery, no join).  Key names are the document's own
(fixed input format).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# --- fixed values: key names of the rules document -------------------------
RULES_SCHEMA = T.StructType([
    T.StructField("valor_vr_diario_padrao", T.DoubleType()),
    T.StructField("percentual_desconto_colaborador", T.DoubleType()),
    T.StructField("percentual_custo_empresa", T.DoubleType()),
    T.StructField("limites", T.StructType([T.StructField("max_desconto", T.DoubleType())])),
    T.StructField("excecoes", T.StructType([
        T.StructField("por_categoria", T.MapType(
            T.StringType(), T.StructType([T.StructField("excluir", T.BooleanType())]))),
        T.StructField("por_sindicato", T.MapType(
            T.StringType(), T.StructType([T.StructField("valor_vr_diario", T.DoubleType())]))),
    ])),
])
DEFAULTS = {"valor_vr_diario_padrao": 0.0, "percentual_desconto_colaborador": 0.2,
            "percentual_custo_empresa": 0.8}
# ---------------------------------------------------------------------------


def read_rules(spark: SparkSession, source: str) -> DataFrame:
    """Inline JSON text (starts with '{') or a path to a JSON file -> one row."""
    if source.strip().startswith("{"):
        return (spark.range(1)
                .select(F.from_json(F.lit(source), RULES_SCHEMA).alias("r")).select("r.*"))
    return spark.read.schema(RULES_SCHEMA).option("multiLine", "true").json(source)


@dataclass(frozen=True)
class Rules:
    """The values of one rules document (defaults applied)."""
    default_value: float = DEFAULTS["valor_vr_diario_padrao"]
    employee_share: float = DEFAULTS["percentual_desconto_colaborador"]
    company_share: float = DEFAULTS["percentual_custo_empresa"]
    max_discount: float | None = None
    excluded_categories: tuple = ()
    union_values: tuple = ()          # (union short name, daily value) pairs


def load_rules(spark: SparkSession, source: str) -> Rules:
    """Parse the document with the fixed schema and take its single row; several documents are an error."""
    rows = read_rules(spark, source).limit(2).collect()
    if len(rows) > 1:
        raise ValueError(f"one rules document is expected, there are more in {source!r}")
    if not rows:
        return Rules()
    row = rows[0]

    def value(name):
        v = row[name]
        return DEFAULTS[name] if v is None else float(v)

    limits, exceptions = row["limites"], row["excecoes"]
    per_category = (exceptions and exceptions["por_categoria"]) or {}
    per_union = (exceptions and exceptions["por_sindicato"]) or {}
    return Rules(
        default_value=value("valor_vr_diario_padrao"),
        employee_share=value("percentual_desconto_colaborador"),
        company_share=value("percentual_custo_empresa"),
        max_discount=None if not limits or limits["max_desconto"] is None else float(limits["max_desconto"]),
        excluded_categories=tuple(sorted(k for k, v in per_category.items() if v and v["excluir"])),
        union_values=tuple(sorted((k, float(v["valor_vr_diario"])) for k, v in per_union.items()
                                  if v and v["valor_vr_diario"] is not None)),
    )
