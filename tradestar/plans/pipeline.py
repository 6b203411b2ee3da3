"""The medallion job: landing -> bronze -> silver -> gold -> marts.

Every step is a Spark job over stored tables; steps hand over only paths.
Each entity is processed in isolation (a failure is reported, the loop goes
on) and every step returns a status DataFrame (entity, rows, status, message)
built from small driver-side metadata (stream progress, write results), never
from collected data.

Layout: ``{root}/{layer}/{domain}/{entity}``, checkpoints under
``{root}/_checkpoints/{domain}/{entity}`` (one path rule for every layer).
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.functions.names import header_clashes, names_by_position
from tradestar.layouts import (REGISTRY_ARCHIVES, REGISTRY_LAYOUTS, TRADE_ENTITIES,
                               TRADE_LAYOUTS, target_schema, target_type)
from tradestar.operators import gold as G
from tradestar.operators import marts as M
from tradestar.operators import quality as Q
from tradestar.operators import silver as SV
from tradestar.session import drop_path, scratch_path
from tradestar.sources import archives as A
from tradestar.sources import files as FS
from tradestar.sources import headers as H
from tradestar.sources import publish as PB
from tradestar.sources import sinks as SK
from tradestar.streaming import ingest as ST

log = logging.getLogger(__name__)
TRADE, REGISTRY = "balancacomercial", "cnpj"
#: Registry status of an active establishment (fixed value).
ACTIVE_STATUS = "02"
REPORT_SCHEMA = "camada string, entidade string, linhas long, status string, mensagem string"


def _absent(exc: Exception) -> bool:
    """Whether the error says that there is no such table or file."""
    return isinstance(exc, AnalysisException) and exc.getCondition() in (
        "PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


@dataclass
class Lake:
    """Where the tables are, and the one format they are written and read in.
    With ``database`` the gold tables are published under its names: readers of
    ``{database}.{table}`` never see a table being replaced."""

    root: str
    fmt: str = "parquet"
    database: str | None = None
    _report: list = field(default_factory=list)

    def path(self, layer: str, domain: str, entity: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{domain}/{entity}"

    def checkpoint(self, domain: str, entity: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{domain}/{entity}"

    def note(self, layer: str, entity: str, rows: int | None, status: str, msg: str | None = None):
        self._report.append((layer, entity, rows, status, msg))

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self._report, REPORT_SCHEMA)


def _each(items, fn, workers: int) -> None:
    """Run ``fn`` per entity; with ``workers > 1`` independent entities are
    submitted from a thread pool (Spark runs jobs from several driver threads
    concurrently, so small reference tables load side by side). ``fn``
    reports its own failures, so one entity never stops the others."""
    items = list(items)
    if workers <= 1:
        for it in items:
            fn(it)
        return
    with ThreadPoolExecutor(max_workers=workers) as pool:
        list(pool.map(fn, items))


# --------------------------------------------------------------------------- bronze
#: Files of one micro-batch of a trade stream.
MAX_FILES = 1000


def bronze_trade(spark: SparkSession, landing: str | None, lake: Lake,
                 entities: dict[str, tuple[str, str | None]] | None = None,
                 workers: int = 1,
                 sources: dict[str, tuple[str, str, str | None]] | None = None) -> None:
    """Checkpointed run-to-completion stream per trade entity: only files not
    seen before are read, each by its own header (absent mapped columns are
    null, unmapped columns dropped); entities without a layout get the fallback
    names. All columns are strings: typing happens in silver, where values that
    do not convert are kept as rejects. A batch id's partition holds its rows (a
    retry replaces it); files that do not fit are listed in ``_rejeitos``.
    ``sources`` (entity -> folder, glob, layout) replaces the single landing
    folder with one per entity."""
    if sources is None:
        sources = {e: (landing, g, lay) for e, (g, lay) in (entities or TRADE_ENTITIES).items()}

    def one(item):
        entity, (folder, glob, layout) = item
        mapping = TRADE_LAYOUTS[layout] if layout is not None else None
        written: list[int] = []

        def per_batch(batch_df: DataFrame, batch_id: int) -> None:
            listing = scratch_path(spark, "heads")
            H.routed(H.read_heads(batch_df), mapping).write.parquet(listing)
            files = spark.read.schema(f"{H.HEAD_SCHEMA}, problema string").parquet(listing)
            unfit = files.filter("problema is not null")
            if n_bad := unfit.count():
                SK.write_idempotent_batch(unfit, lake.path("raw", TRADE, f"_rejeitos/{entity}"), batch_id, lake.fmt)
                lake.note("bronze", f"{entity}/lote_{batch_id}/arquivos", n_bad, "ERRO",
                          f"{n_bad} arquivos de outro layout, listados em _rejeitos/{entity}")
            rows = H.scan_by_header(spark, files, mapping)
            if rows is not None:
                if absent := H.missing_columns(rows, mapping):
                    lake.note("bronze", f"{entity}/lote_{batch_id}", None, "AVISO",
                              f"colunas ausentes: {', '.join(absent)}")
                seen = Observation(f"bronze_{entity}_{batch_id}")
                SK.write_idempotent_batch(rows.observe(seen, F.count(F.lit(1)).alias("n")),
                                          lake.path("raw", TRADE, entity), batch_id, lake.fmt)
                written.append(seen.get["n"])
            drop_path(spark, listing)

        try:
            # names only: Spark does not read the contents of files whose content is not used
            stream = ST.file_stream(spark, folder, A.BINARY_SCHEMA, "binaryFile", glob,
                                    {"maxFilesPerTrigger": str(MAX_FILES)}).select("path")
            ST.run_foreach_batch(stream, lake.checkpoint(TRADE, entity), per_batch)
            there = bool(written) or not A.read_archives(spark, folder, glob).isEmpty()
            lake.note("bronze", entity, sum(written) if there else None,
                      "OK" if sum(written) else "SEM_NOVOS" if there else "SEM_ARQUIVOS")
        except Exception as exc:  # isolate the entity, keep going
            lake.note("bronze", entity, None, "SEM_ARQUIVOS" if _absent(exc) else "ERRO", str(exc) or repr(exc))

    _each(sources.items(), one, workers)


def bronze_registry(spark: SparkSession, landing: str, lake: Lake,
                    entities: list[str] | None = None) -> None:
    """Archive stream per registry entity. Each micro-batch lists its archives'
    members, chooses one of each archive, and reads the chosen ones once into its
    batch id's partition (a retry replaces, never doubles). What cannot be read
    is listed in ``_rejeitos`` with its error; the other archives are loaded."""
    for entity in entities or list(REGISTRY_ARCHIVES):
        glob, folder = REGISTRY_ARCHIVES[entity]
        target = lake.path("raw", REGISTRY, folder)
        written: list[int] = []

        def per_batch(batch_df: DataFrame, batch_id: int, ent=entity, tgt=target,
                      fold=folder, rows=written) -> None:
            listing = scratch_path(spark, "members")
            A.list_members(batch_df).write.parquet(listing)
            members = A.chosen_members(spark.read.schema(A.MEMBER_SCHEMA).parquet(listing))
            records, layout = A.read_members(members), REGISTRY_LAYOUTS[ent]
            unread = members.filter("erro is not null").select("arquivo_zip", "erro")
            n_bad, width = unread.count(), A.max_width(members)
            if width:
                _, missing, surplus = names_by_position(layout, width)
                if missing or surplus:   # positional layouts cannot be checked by name
                    lake.note("bronze", f"{fold}/lote_{batch_id}", None, "AVISO",
                              f"{width} colunas no arquivo, {len(layout)} no layout"
                              + (f"; faltam {', '.join(missing)}" if missing else "")
                              + (f"; a mais {', '.join(surplus)}" if surplus else ""))
                seen = Observation(f"bronze_{fold}_{batch_id}")
                named = A.with_provenance(A.name_fields(
                    records.observe(seen, F.count("registro").alias("n"), F.count("erro").alias("bad")), layout, width))
                SK.write_idempotent_batch(named.hint("rebalance"), tgt, batch_id, lake.fmt)
                rows.append(seen.get["n"])
                if seen.get["bad"] > n_bad:   # some broke off while they were read
                    n_bad, unread = seen.get["bad"], records.filter("erro is not null").select("arquivo_zip", "erro")
            if n_bad:
                SK.write_idempotent_batch(unread, lake.path("raw", REGISTRY, f"_rejeitos/{fold}"), batch_id, lake.fmt)
                lake.note("bronze", f"{fold}/lote_{batch_id}/arquivos", n_bad, "ERRO",
                          f"{n_bad} arquivos ilegíveis, listados em _rejeitos/{fold}")
            drop_path(spark, listing)

        try:
            ST.run_foreach_batch(A.stream_archives(spark, landing, glob),
                                 lake.checkpoint(REGISTRY, folder), per_batch)
            lake.note("bronze", folder, sum(written), "OK" if written else "SEM_NOVOS")
        except Exception as exc:
            lake.note("bronze", folder, None, "ERRO", str(exc))


# --------------------------------------------------------------------------- silver
def _types_for(columns: list[str], layout: str | None) -> dict[str, str]:
    if layout is None:
        return {}
    targets = set(TRADE_LAYOUTS[layout].values())
    return {c: target_type(c).simpleString() for c in columns
            if c in targets and target_type(c).simpleString() != "string"}


def silver_trade(spark: SparkSession, lake: Lake, entities: list[str] | None = None,
                 workers: int = 1) -> None:
    """trim/upper -> strong typing (``try_cast``; rows whose non-null text does
    not convert go to a ``_rejeitos`` table with the failed columns) -> dedup
    -> null fill (codes, states, year and month keep their nulls) -> overwrite
    partitioned by year/month. Row and reject counts come from ``observe`` on
    the writes, not from extra scans."""
    def one(entity):
        try:
            df = SK.read_merged(spark, lake.path("raw", TRADE, entity), lake.fmt)
            if df.isEmpty():
                lake.note("silver", entity, 0, "VAZIO", "entrada vazia, ignorada")
                return
            df = df.drop("batch_id")
            text = SV.trim_upper_strings(SV.normalize_headers(df))
            typed = SV.typed_columns(text, _types_for(text.columns, TRADE_ENTITIES[entity][1]))
            clean, rejects = SV.split_rejects(typed)
            obs_rej = Observation(f"rej_{entity}")
            rejects = rejects.observe(obs_rej, F.count(F.lit(1)).alias("n"))
            SK.overwrite_table(rejects, lake.path("trusted", TRADE, f"_rejeitos/{entity}"), fmt=lake.fmt)
            out = SV.treat_nulls(SV.dedup_rows(clean), protect=SV.key_columns(clean.columns))
            obs = Observation(f"silver_{entity}")
            SK.overwrite_partitioned(out.observe(obs, F.count(F.lit(1)).alias("n")),
                                     lake.path("trusted", TRADE, entity), fmt=lake.fmt)
            n_rej = obs_rej.get.get("n", 0)
            notes = [f"{n_rej} linhas rejeitadas na tipagem"] if n_rej else []
            notes += [f"coluna {h!r} repetida, gravada como {n}" for h, n in header_clashes(df.columns)]
            layout = TRADE_ENTITIES[entity][1]
            if layout is not None:   # schema check from metadata only (no data pass)
                probs = SV.schema_problems(df.schema, T.StructType(
                    [T.StructField(c, T.StringType()) for c in TRADE_LAYOUTS[layout].values()]))
                notes += [f"{c}: {p}" for c, p, _, _ in probs]
            lake.note("silver", entity, obs.get.get("n"), "OK", "; ".join(notes) or None)
        except Exception as exc:
            lake.note("silver", entity, None, "SEM_DADOS" if _absent(exc) else "ERRO", str(exc))

    _each(entities or list(TRADE_ENTITIES), one, workers)


def silver_registry(spark: SparkSession, lake: Lake, entities: list[str] | None = None) -> None:
    for entity in entities or list(REGISTRY_ARCHIVES):
        folder = REGISTRY_ARCHIVES[entity][1]
        try:
            # batches may differ in width: every column of every batch
            df = SK.read_merged(spark, lake.path("raw", REGISTRY, folder), lake.fmt)
            if df.isEmpty():
                lake.note("silver", folder, 0, "VAZIO", "entrada vazia, ignorada")
                continue
            clean = SV.silver_clean_registry(df.drop("batch_id"))
            _overwrite(lake, "silver", folder, clean, lake.path("trusted", REGISTRY, folder))
        except Exception as exc:
            lake.note("silver", folder, None, "SEM_DADOS" if _absent(exc) else "ERRO", str(exc))


# --------------------------------------------------------------------------- gold
def _overwrite(lake: Lake, layer: str, entity: str, df: DataFrame, path: str,
               partition_by: list[str] | None = None, message: str | None = None,
               sort_by: tuple[str, ...] = ()) -> None:
    """Write a table (publish it, if it is gold and the lake has a database) and
    report the rows that were written."""
    seen = Observation(f"{layer}_{entity}")
    df = df.observe(seen, F.count(F.lit(1)).alias("n"))
    if layer == "gold" and lake.database:
        PB.publish(df, f"{lake.database}.{entity}", path, partition_by or (), sort_by)
    else:
        SK.overwrite_table(df, path, partition_by, lake.fmt)
    lake.note(layer, entity, seen.get["n"], "OK", message)


class _Inputs:
    """Trusted tables for gold. An absent one is reported; it is an error of the
    tables that need it unless the caller allows that. Any other error is too."""

    def __init__(self, spark: SparkSession, lake: Lake, allowed: frozenset[str]) -> None:
        self.spark, self.lake, self.allowed = spark, lake, allowed
        self.read: dict[str, DataFrame | None] = {}

    def __call__(self, entity: str, empty: str | T.StructType | None = None, domain: str = TRADE) -> DataFrame | None:
        """The table; where it may be absent, an empty one of schema ``empty``
        (or None). Raises if the table is absent and must not be."""
        if entity not in self.read:
            path = self.lake.path("trusted", domain, entity)
            try:
                self.read[entity] = FS.read_table(self.spark, path, self.lake.fmt)
            except AnalysisException as exc:
                if not _absent(exc):
                    raise
                self.read[entity] = None
                self.lake.note("gold", f"entrada/{entity}", None, "AUSENTE",
                               "permitida" if entity in self.allowed else "necessária")
        found = self.read[entity]
        if found is None and entity not in self.allowed:
            raise LookupError(f"entrada {entity} ausente")
        return self.spark.createDataFrame([], empty) if found is None and empty is not None else found


def gold(spark: SparkSession, lake: Lake, cluster_fact: bool = True,
         year_partition: bool = False, sentinels: tuple[str, ...] = (),
         unknown_member: bool = False, allow_absent: frozenset[str] | tuple[str, ...] = (),
         activities: DataFrame | None = None) -> None:
    """Dimensions, the fact and the establishment distribution, each written as
    its own table and reported on its own. A table is written only from all of
    its inputs: one that cannot be read, or is absent and not named in
    ``allow_absent``, leaves the table as it is with status ERRO or SEM_DADOS.

    The fact is partitioned by movement (and, with ``year_partition``, by
    reference year) and, with ``cluster_fact``, ranged and sorted by (sk_data,
    sk_ncm), so a month or product filter skips files. Rows that the quality
    gate rejects are written by the same pass, beside the fact, with their
    reasons (``gold_rejects``), and counted in the report. ``sentinels`` (e.g.
    ('N/A',)) are read as missing values; ``activities``, a versioned mapping of
    products, gives the product dimension its activity and sector."""
    t = _Inputs(spark, lake, frozenset(allow_absent))
    parts = ["tipo_movimentacao"] + ["ano_ref"] * year_partition

    def sides() -> tuple[DataFrame, DataFrame]:
        return t("exp", target_schema("EXPO_2021")), t("imp", target_schema("IMP_2021"))

    def date() -> DataFrame:
        return G.build_dim_date(*sides()).sortWithinPartitions("sk_data")

    def product() -> DataFrame:
        return G.build_dim_product(t("ncm"), t("ncm_fat_agreg"), t("ncm_ppe"), sentinels,
                                   None if activities is None else Q.current_activities(activities))

    def transport() -> DataFrame:
        return G.build_dim_transport(t("via"), sentinels)

    def geography() -> DataFrame:
        blocs = t("pais_bloco", "codigo_pais string, nome_bloco_pt string")
        return G.build_dim_geography(t("pais"), blocs, *sides(), t("uf"), sentinels, unknown_member)

    def fact() -> DataFrame:
        out = G.flagged_fact(*sides(), sentinels=sentinels)
        if year_partition:
            out = out.withColumn("ano_ref", (F.col("sk_data") / 100).cast("int"))
        return G.clustered(out, ["rejeitada", *parts]) if cluster_fact else out

    def distribution() -> DataFrame:
        latest = ["ingestion_timestamp", "file_source"]
        newest = lambda df, *keys: SV.dedup_latest(df, list(keys), latest)
        places = t("estabelecimentos", domain=REGISTRY).filter(F.col("cnpj_basico").isNotNull())
        firms = t("empresas", domain=REGISTRY).filter(F.col("cnpj_basico").isNotNull())
        return M.establishment_distribution(
            newest(places, "cnpj_basico", "cnpj_ordem", "cnpj_dv"), newest(firms, "cnpj_basico"),
            t("cnaes", "cnae string, descricao string", REGISTRY), active_status=ACTIVE_STATUS)

    for name, build, by in (("dim_data", date, None), ("dim_ncm", product, None),
                            ("dim_via_transporte", transport, None), ("dim_geografia", geography, None),
                            ("ft_balanco_comercial", fact, ["rejeitada", *parts]),
                            ("dim_distribuicao_estabelecimentos", distribution, ["uf"])):
        try:
            df = build()
            df = (df.withColumn("dt_atualizacao", F.current_timestamp()).hint("rebalance", "uf")
                  if by == ["uf"] else G.add_audit(df))
            path = lake.path("refined", "gold", name)
            if name == FACT:
                _write_fact(spark, lake, df, path, by)
            else:
                _overwrite(lake, "gold", name, df, path, by)
        except LookupError as exc:
            lake.note("gold", name, None, "SEM_DADOS", str(exc))
        except Exception as exc:  # this table stays as it was; the others go on
            lake.note("gold", name, None, "ERRO", str(exc))


FACT, REJECTS = "ft_balanco_comercial", "ft_balanco_comercial_rejeitos"


def _write_fact(spark: SparkSession, lake: Lake, flagged: DataFrame, path: str, by: list[str]) -> None:
    """Fact and rejects from one pass over the input: one write, in folders by
    flag. Published, both names are views of one version, so they never differ
    in age."""
    seen = Observation("gold_fato")
    rows = flagged.observe(seen, *G.gate_counts())
    if lake.database:
        whole = f"{lake.database}.{FACT}_linhas"
        PB.publish(rows, whole, path, by, ("sk_data", "sk_ncm"))
        for name, test, dropped in ((FACT, "NOT rejeitada", "rejeitada, motivo"), (REJECTS, "rejeitada", "rejeitada")):
            spark.sql(f"CREATE OR REPLACE VIEW {lake.database}.{name} AS "
                      f"SELECT * EXCEPT ({dropped}) FROM {whole} WHERE {test}")
    else:
        SK.overwrite_table(rows, path, by, lake.fmt)
    n = seen.get
    lake.note("gold", FACT, n["aceitas"], "OK")
    if rejected := n["linhas"] - n["aceitas"]:
        lake.note("gold", REJECTS, rejected, "AVISO", "; ".join(
            f"{reason}: {n[reason]}" for reason in G.REJECT_REASONS if n[reason]))


def _by_flag(spark: SparkSession, lake: Lake, rejected: bool) -> DataFrame:
    # the flag is read as a partition column, so the other side's folder is not opened
    rows = FS.read_table(spark, lake.path("refined", "gold", FACT), lake.fmt)
    return rows.filter(F.col("rejeitada") == F.lit(rejected)).drop("rejeitada")


def gold_rejects(spark: SparkSession, lake: Lake) -> DataFrame:
    """Fact rows that the quality gate rejected, with their reasons."""
    return spark.table(f"{lake.database}.{REJECTS}") if lake.database else _by_flag(spark, lake, True)


def gold_table(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    if lake.database:
        return spark.table(f"{lake.database}.{name}")
    if name == FACT:
        return _by_flag(spark, lake, False).drop("motivo")
    return FS.read_table(spark, lake.path("refined", "gold", name), lake.fmt)


def marts(spark: SparkSession, lake: Lake, min_year: int) -> dict[str, DataFrame]:
    """Reports over the stored gold tables (lazy); the monthly snapshot is
    written with dynamic partition overwrite by month."""
    fact = gold_table(spark, lake, "ft_balanco_comercial")
    dim_data = gold_table(spark, lake, "dim_data")
    seen = Observation("agregado_mensal")
    SK.write_snapshot(M.agg_monthly_snapshot(fact).observe(seen, F.count(F.lit(1)).alias("n")),
                      lake.path("refined", "marts", "agregado_mensal"), ["sk_data"], lake.fmt)
    lake.note("marts", "agregado_mensal", seen.get["n"], "OK")
    return {
        "balanca_mensal": M.mart_monthly_balance(fact, dim_data, min_year),
        "exportacao_trimestral": M.mart_quarterly_exports(fact, dim_data),
        "kpi_mensal": M.kpi_mom_yoy(M.kpi_monthly(fact, dim_data)),
    }


def run(spark: SparkSession, landing: str, root: str, min_year: int = 2000,
        workers: int = 4, allow_absent: frozenset[str] | tuple[str, ...] = (),
        database: str | None = None) -> DataFrame:
    """The whole job; returns the run report. ``workers`` trade entities are
    loaded concurrently in bronze and silver; gold tables go without the inputs
    named in ``allow_absent`` if these are absent, and are published in
    ``database`` if one is named."""
    lake = Lake(root, FS.table_format(spark), database)
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{lake.path('refined', 'catalog', database)}'")
    bronze_trade(spark, landing, lake, workers=workers)
    bronze_registry(spark, landing, lake)
    silver_trade(spark, lake, workers=workers)
    silver_registry(spark, lake)
    for step, call in (("gold", lambda: gold(spark, lake, allow_absent=allow_absent)),
                       ("marts", lambda: marts(spark, lake, min_year))):
        try:
            call()
        except Exception as exc:  # report the failed step, keep the report
            lake.note(step, "*", None, "ERRO", str(exc))
    return lake.report(spark)


if __name__ == "__main__":  # pragma: no cover
    import sys

    # the master, the resources and all other settings are spark-submit's
    run(SparkSession.builder.appName("tradestar").getOrCreate(), sys.argv[1], sys.argv[2]).show(100, truncate=False)
