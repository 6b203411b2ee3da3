"""The medallion job on the driver's tables, end to end.

The trade entities are written as landing files in their source layouts
(headers by source name, ``;``, ISO-8859-1), then the job streams them into
bronze, cleans and types them in silver and builds the gold star. The query
returns the stored gold fact; its SQL twin applies the same steps (silver's
full-row dedup, the fact's quality gate) to the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradestar.layouts import TRADE_LAYOUTS
from tradestar.operators.gold import AUDIT_COLUMN
from tradestar.plans import pipeline as P
from tradestar.plans import trusted
from tradestar.plans.registry import register
from tradestar.plans.sql import fact_side_sql
from tradestar.session import scratch_path
from tradestar.sources import files as FS
from tradestar.sources import sinks as SK
from tradestar.sources import standins as S

# entity -> layout of the landing files written from the driver's tables
JOB_ENTITIES = {"exp": "EXPO_2021", "imp": "IMP_2021", "ncm": "NCM",
                "ncm_fat_agreg": "NCM_FAT_AGREG", "ncm_ppe": "NCM_PPE", "via": "VIA",
                "pais": "PAIS", "pais_bloco": "PAIS_BLOCO", "uf": "UF"}


def to_landing(df: DataFrame, layout: str) -> DataFrame:
    """Rename bronze names back to the source headers of ``layout``."""
    return df.select(*[F.col(dst).alias(src) for src, dst in TRADE_LAYOUTS[layout].items()
                       if dst in df.columns])


def write_landing(spark, d, landing: str) -> dict[str, tuple[str, str, str]]:
    exp, imp = trusted.exp_imp(spark, d)
    frames = {"exp": exp, "imp": imp, "ncm": S.ncm(spark, d),
              "ncm_fat_agreg": S.ncm_fat_agreg(spark, d), "ncm_ppe": S.ncm_ppe(spark, d),
              "via": S.via(spark, d), "pais": S.pais(spark, d),
              "pais_bloco": S.pais_bloco(spark, d), "uf": S.uf(spark, d)}
    sources = {}
    for entity, layout in JOB_ENTITIES.items():
        folder = f"{landing}/{entity}"
        to_landing(frames[entity], layout).write.options(**FS.LANDING_OPTIONS).csv(folder)
        sources[entity] = (folder, "*.csv", layout)
    return sources


def run_job(spark, d) -> P.Lake:
    root = scratch_path(spark, "job")
    sources = write_landing(spark, d, f"{root}/landing")
    lake = P.Lake(f"{root}/lake")
    P.bronze_trade(spark, None, lake, sources=sources, workers=4)
    P.silver_trade(spark, lake, entities=list(sources), workers=4)
    P.gold(spark, lake)
    return lake


@register("medallion_job", "WITH exp_d AS (SELECT DISTINCT * FROM exp), "
          "imp_d AS (SELECT DISTINCT * FROM imp)\nSELECT * FROM ("
          + fact_side_sql("exp_d", "EXPORTACAO", "codigo_pais_destino", "uf_origem")
          + "\n    UNION ALL BY NAME"
          + fact_side_sql("imp_d", "IMPORTACAO", "codigo_pais_origem", "uf_destino")
          + ") f WHERE sk_ncm IS NOT NULL AND sk_data IS NOT NULL")
def q_medallion_job(spark, d):
    """landing CSV -> bronze stream -> silver (clean, type, dedup) -> gold fact."""
    lake = run_job(spark, d)
    return P.gold_table(spark, lake, "ft_balanco_comercial").drop(AUDIT_COLUMN)


#: Headers under one glob, by month: files of the first quarter of a year as the
#: layout has them, the others in another order, without two columns, with two more.
NARROW_WITHOUT = ("codigo_via_transporte", "codigo_alfandega")


def _variants(exp: DataFrame) -> dict[str, DataFrame]:
    quarter = lambda k: to_landing(exp.filter(F.ceil(F.col("mes") / 3) == k), "EXPO_2021")
    reordered, narrow, wide = quarter(2), quarter(3), quarter(4)
    lost = [src for src, dst in TRADE_LAYOUTS["EXPO_2021"].items() if dst in NARROW_WITHOUT]
    return {"a": quarter(1), "b": reordered.select(*reversed(reordered.columns)), "c": narrow.drop(*lost),
            "d": wide.select(F.lit("x;y").alias("OBS 1"), "*", F.lit("z").alias("OBS 2"))}


@register("headers_routed", """
SELECT ano, mes, count(*) AS linhas, sum(valor_fob_usd)::DECIMAL(38,2) AS valor_fob,
       sum(peso_liquido_kg)::DECIMAL(38,2) AS peso,
       CASE WHEN mes BETWEEN 7 AND 9 THEN 0 ELSE count(codigo_via_transporte) END AS com_via
FROM exp GROUP BY ano, mes
UNION ALL SELECT NULL, NULL, 1, NULL, NULL, NULL""")
def q_headers_routed(spark, d):
    """Exports landed under one glob with four headers, the narrowest first; a
    second run over the same checkpoint loads the others and one file of another
    layout, which is listed and counted in the row without a month."""
    root = scratch_path(spark, "headers")
    exp, _ = trusted.exp_imp(spark, d)
    variants = _variants(exp)
    lake = P.Lake(f"{root}/lake")
    for names in (["c"], ["d", "b", "a"]):
        for name in names:
            variants[name].write.options(**FS.LANDING_OPTIONS).csv(f"{root}/landing/{name}")
        if "a" in names:
            S.table(spark, d, "region").coalesce(1).write.options(**FS.LANDING_OPTIONS).csv(f"{root}/landing/e")
        P.bronze_trade(spark, None, lake, sources={"exp": (f"{root}/landing/*", "*.csv", "EXPO_2021")})
    rows = SK.read_merged(spark, lake.path("raw", P.TRADE, "exp"))
    money = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("decimal(38,2)")
    by_month = rows.groupBy(F.col("ano").cast("int").alias("ano"), F.col("mes").cast("int").alias("mes")).agg(
        F.count(F.lit(1)).alias("linhas"), money("valor_fob_usd").alias("valor_fob"),
        money("peso_liquido_kg").alias("peso"), F.count("codigo_via_transporte").alias("com_via"))
    unfit = SK.read_merged(spark, lake.path("raw", P.TRADE, "_rejeitos/exp")).agg(F.count(F.lit(1)).alias("linhas"))
    return by_month.unionByName(unfit, allowMissingColumns=True)
