"""Analytical marts over the star schema.

Plan shape used throughout: filter the fact (pushed to the scan), aggregate it
on the dimension key first (partial + final hash aggregate, output bounded by
the dimension's cardinality), then join the small aggregate to the dimension
and regroup by the reported attributes. The fact is never joined row by row,
so no fact-sized shuffle or broadcast happens for a join; the regroup keeps
the result identical to join-then-aggregate even if a dimension key repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradestar.functions import keys as K
from tradestar.operators.validity import valid_in_month, validity_ranges

DEC = "decimal(38,2)"


def _sum(c, alias: str):
    return F.sum(c).cast(DEC).alias(alias)


def _flow(value: str, tipo: str):
    return F.when(F.col("tipo_movimentacao") == tipo, F.col(value)).otherwise(F.lit(0))


def monthly_flows(fact: DataFrame) -> DataFrame:
    """Exports and imports per month key (the KPI base)."""
    return fact.groupBy("sk_data").agg(_sum(_flow("valor_fob", K.EXPORT), "exportacao"),
                                       _sum(_flow("valor_fob", K.IMPORT), "importacao"))


def mart_monthly_balance(fact: DataFrame, dim_date: DataFrame, min_year: int) -> DataFrame:
    """Exports, imports and balance per month from ``min_year`` on."""
    months = dim_date.filter(F.col("ano") >= min_year).select("sk_data", "ano", "mes", "nome_mes")
    return (monthly_flows(fact).join(months, "sk_data")
            .groupBy("ano", "mes", "nome_mes")
            .agg(_sum("exportacao", "total_exportacao"), _sum("importacao", "total_importacao"))
            .withColumn("saldo_comercial",
                        (F.col("total_exportacao") - F.col("total_importacao")).cast(DEC))
            .orderBy(F.desc("ano"), F.desc("mes")))


def mart_quarterly_exports(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Exports per year and quarter."""
    by_month = (fact.filter(F.col("tipo_movimentacao") == K.EXPORT)
                .groupBy("sk_data").agg(_sum("valor_fob", "v")))
    return (by_month.join(dim_date.select("sk_data", "ano", "trimestre"), "sk_data")
            .groupBy("ano", "trimestre").agg(_sum("v", "total_exportado"))
            .orderBy(F.desc("ano"), F.desc("trimestre")))


def mart_years(fact: DataFrame, dim_date: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Flows by quarter of some years, from a fact partitioned by ``ano_ref``.
    The years are named on the dimension alone; the join on the partition column
    lets Spark prune the fact's folders by what the dimension's filter leaves
    (dynamic partition pruning)."""
    months = dim_date.filter(F.col("ano").between(first_year, last_year)).select(
        "sk_data", F.col("ano").alias("ano_ref"), "trimestre")
    by_month = fact.groupBy("ano_ref", "sk_data", "tipo_movimentacao").agg(_sum("valor_fob", "v"))
    return (by_month.join(months, ["ano_ref", "sk_data"])
            .groupBy(F.col("ano_ref").alias("ano"), "trimestre", "tipo_movimentacao").agg(_sum("v", "valor_total")))


def mart_top_products(fact: DataFrame, dim_product: DataFrame, sk_from: int, sk_to: int,
                      k: int = 10) -> DataFrame:
    """Top-k exported products by value in a month-key range (top-k is the
    feature: ``orderBy().limit()`` plans as TakeOrderedAndProject)."""
    by_product = (fact.filter((F.col("tipo_movimentacao") == K.EXPORT)
                              & F.col("sk_data").between(sk_from, sk_to))
                  .groupBy("sk_ncm").agg(_sum("valor_fob", "v"), _sum("kg_liquido", "kg")))
    return (by_product.join(dim_product.select("sk_ncm", "codigo_ncm", "nome_ncm",
                                               "nomenclatura_ppe"), "sk_ncm")
            .groupBy("codigo_ncm", "nome_ncm", "nomenclatura_ppe")
            .agg(_sum("v", "valor_total_exportado"), _sum("kg", "peso_liquido_total"))
            .orderBy(F.desc("valor_total_exportado"), F.asc("codigo_ncm"))
            .limit(k))


def mart_top_products_by_sector(fact: DataFrame, dim_product: DataFrame, activities: DataFrame, sk_from: int,
                                sk_to: int, k: int = 10) -> DataFrame:
    """Top-k exported products in a month-key range by the sector that each had
    in the month of its exports: a product whose sector changes within the range
    has a row for each. ``activities`` is the versioned mapping of products.

    Values are summed by product and month first; only these sums meet the
    mapping's ranges, by product and year."""
    ranges = validity_ranges(activities, "codigo_ncm", "vigente_desde", "versao")
    by_month = (fact.filter((F.col("tipo_movimentacao") == K.EXPORT)
                            & F.col("sk_data").between(sk_from, sk_to))
                .groupBy("sk_ncm", "sk_data").agg(_sum("valor_fob", "v"), _sum("kg_liquido", "kg")))
    named = by_month.join(dim_product.select("sk_ncm", "codigo_ncm", "nome_ncm"), "sk_ncm")
    dated = valid_in_month(named, ranges, "codigo_ncm", "sk_data", ["setor_economico"], sk_from // 100, sk_to // 100)
    return (dated.groupBy("codigo_ncm", "nome_ncm", "setor_economico")
            .agg(_sum("v", "valor_total_exportado"), _sum("kg", "peso_liquido_total"))
            .orderBy(F.desc("valor_total_exportado"), "codigo_ncm", "setor_economico").limit(k))


def mart_sectors(fact: DataFrame, dim_product: DataFrame, activities: DataFrame, sk_from: int,
                 sk_to: int) -> DataFrame:
    """Exports by month and the sector that each product had in that month."""
    ranges = validity_ranges(activities, "codigo_ncm", "vigente_desde", "versao")
    by_month = (fact.filter((F.col("tipo_movimentacao") == K.EXPORT)
                            & F.col("sk_data").between(sk_from, sk_to))
                .groupBy("sk_ncm", "sk_data").agg(_sum("valor_fob", "v")))
    named = by_month.join(dim_product.select("sk_ncm", "codigo_ncm"), "sk_ncm")
    dated = valid_in_month(named, ranges, "codigo_ncm", "sk_data", ["setor_economico", "cnae"],
                           sk_from // 100, sk_to // 100)
    return dated.groupBy("sk_data", "setor_economico").agg(
        _sum("v", "valor_total_exportado"), F.count_distinct("cnae").alias("atividades"))


def mart_partners(fact: DataFrame, dim_geo: DataFrame, tipo: str = K.IMPORT) -> DataFrame:
    """Value by partner geography for one movement type."""
    by_geo = (fact.filter(F.col("tipo_movimentacao") == tipo)
              .groupBy("sk_geografia").agg(_sum("valor_fob", "v")))
    return (by_geo.join(dim_geo.select("sk_geografia", "nome_geografia", "nivel"), "sk_geografia")
            .groupBy("nome_geografia", "nivel").agg(_sum("v", "valor_total"))
            .orderBy(F.desc("valor_total"), F.asc("nome_geografia")))


def mart_partner_state(fact: DataFrame, dim_geo: DataFrame) -> DataFrame:
    """Role-playing geography: partner country and home state of each flow."""
    agg = (fact.groupBy("sk_geografia", "sk_geografia_uf", "tipo_movimentacao")
           .agg(_sum("valor_fob", "v")))
    country = (dim_geo.filter(F.col("nivel") == K.LEVEL_COUNTRY)
               .select("sk_geografia", F.col("nome_geografia").alias("pais")))
    state = dim_geo.filter(F.col("nivel") == K.LEVEL_STATE).select(F.col("sk_geografia").alias("sk_geografia_uf"),
                           F.col("sigla").alias("uf"))
    return (agg.join(country, "sk_geografia").join(state, "sk_geografia_uf")
            .groupBy("pais", "uf", "tipo_movimentacao").agg(_sum("v", "valor_total"))
            .orderBy(F.desc("valor_total"), "pais", "uf", "tipo_movimentacao"))


def mart_transport(fact: DataFrame, dim_transport: DataFrame) -> DataFrame:
    """Value and weight by transport mode and movement."""
    agg = (fact.groupBy("sk_via_transporte", "tipo_movimentacao")
           .agg(_sum("valor_fob", "v"), _sum("kg_liquido", "kg")))
    return (agg.join(dim_transport.select("sk_via_transporte", "nome_via"), "sk_via_transporte")
            .groupBy("nome_via", "tipo_movimentacao")
            .agg(_sum("v", "valor_total"), _sum("kg", "peso_total_kg"))
            .orderBy(F.desc("valor_total")))


def kpi_monthly(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Export, import, balance (saldo) and total trade (corrente) per month."""
    return (monthly_flows(fact).join(dim_date.select("sk_data", "ano", "mes"), "sk_data")
            .groupBy("sk_data", "ano", "mes")
            .agg(_sum("exportacao", "exportacao"), _sum("importacao", "importacao"))
            .withColumn("saldo", (F.col("exportacao") - F.col("importacao")).cast(DEC))
            .withColumn("corrente", (F.col("exportacao") + F.col("importacao")).cast(DEC)))


KPI_COLUMNS = ["exportacao", "importacao", "saldo", "corrente"]


def _pct_change(cur: str, prev: str):
    return F.try_divide((F.col(cur) - F.col(prev)).cast("double"),
                        F.nullif(F.col(prev), F.lit(0)).cast("double"))


def kpi_mom_yoy(kpi: DataFrame) -> DataFrame:
    """Month-over-month and year-over-year change of each KPI.

    Gap-safe: the previous month / same month last year is found by joining on
    the month index ``ano*12 + mes`` (a missing month gives null, never the
    wrong neighbour). The input is the monthly KPI table, so these joins
    touch one row per month.
    """
    base = kpi.withColumn("_idx", F.col("ano") * 12 + F.col("mes"))

    def shifted(offset: int, suffix: str) -> DataFrame:
        return base.select((F.col("_idx") + offset).alias("_idx"),
                           *[F.col(c).alias(f"{c}_{suffix}") for c in KPI_COLUMNS])

    out = (base.join(shifted(1, "m1"), "_idx", "left")
           .join(shifted(12, "y1"), "_idx", "left"))
    cols = ["sk_data", "ano", "mes", *KPI_COLUMNS]
    for c in KPI_COLUMNS:
        cols.append(_pct_change(c, f"{c}_m1").alias(f"{c}_mom"))
        cols.append(_pct_change(c, f"{c}_y1").alias(f"{c}_yoy"))
    return out.select(*cols)


def agg_monthly_snapshot(fact: DataFrame) -> DataFrame:
    """Pre-calculated aggregate per month × movement × partner, to be written
    partitioned by ``sk_data`` with dynamic partition overwrite."""
    return (fact.groupBy("sk_data", "tipo_movimentacao", "sk_geografia")
            .agg(_sum("valor_fob", "valor_fob"), _sum("kg_liquido", "kg_liquido"),
                 _sum("quantidade", "quantidade"), F.count(F.lit(1)).alias("n_registros")))


# ---------------------------------------------------------------------------
# FIXED VALUES — company size codes of the registry and their descriptions.
# ---------------------------------------------------------------------------
COMPANY_SIZE = {
    "00": "NAO INFORMADO",
    "01": "MICRO EMPRESA",
    "03": "EMPRESA DE PEQUENO PORTE",
    "05": "DEMAIS",
}
# --------------------------------------------------------------------------- end fixed values


def company_size_name(code):
    pairs = [x for k, v in COMPANY_SIZE.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.create_map(*pairs)[code], code)


def establishment_distribution(estab: DataFrame, companies: DataFrame, cnaes: DataFrame,
                               active_status: str) -> DataFrame:
    """Active establishments counted by activity × company size × state.

    Establishments are counted per company, activity and state first, so a
    company with many of them joins as a few rows; a row without a company key
    belongs to no company. The activity lookup has one description per code.
    """
    per_company = (estab.filter((F.col("situacao_cadastral") == active_status) & F.col("cnpj_basico").isNotNull())
                   .groupBy("cnpj_basico", "cnae_principal", "uf").agg(F.count(F.lit(1)).alias("n")))
    counted = (per_company.join(companies.select("cnpj_basico", "porte"), "cnpj_basico")
               .groupBy("cnae_principal", "porte", "uf").agg(F.sum("n").alias("n")))
    activities = cnaes.groupBy(F.col("cnae").alias("cnae_principal")).agg(F.min("descricao").alias("descricao"))
    return (counted.join(activities, "cnae_principal", "left")
            .groupBy(F.col("cnae_principal").alias("cnae_fiscal_principal"), "descricao",
                     company_size_name(F.col("porte")).alias("porte_empresa"), "uf")
            .agg(F.sum("n").cast("bigint").alias("Total_empresas")))


def mart_state_vocation(distribution: DataFrame, uf: str, k: int = 10) -> DataFrame:
    """Top-k activities of one state by establishment count."""
    return (distribution.filter(F.col("uf") == uf)
            .groupBy("uf", F.col("descricao").alias("atividade_economica"))
            .agg(F.sum("Total_empresas").cast("bigint").alias("total_estabelecimentos"))
            .orderBy(F.desc("total_estabelecimentos"), F.asc("atividade_economica"))
            .limit(k))


#: Levels of the subtotals: what they are taken by, besides month and movement.
SUBTOTALS = {"total": None, "produto": "sk_ncm", "parceiro": "sk_geografia", "estado": "sk_geografia_uf"}


def trade_subtotals(fact: DataFrame) -> DataFrame:
    """Totals by product, by partner, by state and overall of each month and
    movement, in one table and one pass: ``nivel`` names what ``chave`` is (null
    for the total). Rows are summed at the finest grain before they are repeated
    for each level. Every row belongs to one month, so a refresh replaces the
    months that changed (``write_snapshot`` by ``sk_data``) and no others."""
    keys = [k for k in SUBTOTALS.values() if k]
    grain = fact.groupBy("sk_data", "tipo_movimentacao", *keys).agg(
        _sum("valor_fob", "v"), _sum("kg_liquido", "kg"), F.count(F.lit(1)).alias("n"))
    sets = [["sk_data", "tipo_movimentacao", *([k] if k else [])] for k in SUBTOTALS.values()]
    rows = grain.groupingSets([[F.col(c) for c in s] for s in sets], "sk_data", "tipo_movimentacao", *keys).agg(
        _sum("v", "valor_total"), _sum("kg", "peso_total"), F.sum("n").alias("registros"),
        *[F.grouping(k).alias(f"_{k}") for k in keys])
    level = F.coalesce(*[F.when(F.col(f"_{k}") == 0, F.lit(name)) for name, k in SUBTOTALS.items() if k],
                       F.lit("total"))
    return rows.select("sk_data", "tipo_movimentacao", level.alias("nivel"), F.coalesce(*keys).alias("chave"),
                       "valor_total", "peso_total", "registros")
