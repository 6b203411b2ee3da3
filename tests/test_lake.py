"""Publication, rejects in the job, the catalogue's estimates, mappings over time."""

import threading

import pytest
from pyspark.sql import functions as F

from tradestar.operators import catalogue as C
from tradestar.operators import gold as G
from tradestar.operators import marts as M
from tradestar.operators import quality as Q
from tradestar.operators import validity as V
from tradestar.plans import pipeline as P
from tradestar.plans import q_gold as QG
from tradestar.plans import q_lake as QL
from tradestar.sources import publish as PB
from tradestar.sources import sinks as SK

from conftest import SF_SMALL


@pytest.fixture()
def database(spark, tmp_path):
    name = f"db_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def generation(spark, g, n=2000):
    return spark.range(n).select(F.col("id"), F.lpad((F.col("id") % 4).cast("string"), 2, "0").alias("p"),
                                 F.lit(g).alias("g"))


# --------------------------------------------------------------------------- publication
def test_a_reader_sees_one_generation_whole(spark, tmp_path, database):
    name = f"{database}.t"
    PB.publish(generation(spark, 0), name, str(tmp_path / "t"), ["p"], keep=4)
    seen, stop = [], threading.Event()

    def reader():
        while not stop.is_set():
            seen.append([tuple(r) for r in spark.table(name).groupBy("g").count().collect()])

    thread = threading.Thread(target=reader)
    thread.start()
    for g in range(1, 4):
        PB.publish(generation(spark, g), name, str(tmp_path / "t"), ["p"], keep=4)
    stop.set()
    thread.join()
    assert seen and all(len(s) == 1 and s[0][1] == 2000 for s in seen)


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path, database):
    name = f"{database}.t"
    first = PB.publish(generation(spark, 1), name, str(tmp_path / "t"))
    with pytest.raises(Exception, match="no luck"):
        PB.publish(generation(spark, 2).withColumn("g", F.raise_error(F.lit("no luck")).cast("int")), name,
                   str(tmp_path / "t"))
    assert PB.current(spark, name) == first and spark.table(name).filter("g = 1").count() == 2000
    assert len(PB.versions(spark, name)) == 1


def test_old_versions_go_and_schemas_may_change(spark, tmp_path, database):
    name = f"{database}.t"
    for g in range(4):
        PB.publish(generation(spark, g).withColumn(f"c{g}", F.lit("x")), name, str(tmp_path / "t"), keep=2)
    kept = PB.versions(spark, name)
    assert len(kept) == 2 and kept[-1] == PB.current(spark, name)
    assert sorted(x.name for x in (tmp_path / "t").iterdir()) == [v.rpartition(".")[2] for v in kept]
    assert spark.table(name).columns == ["id", "p", "g", "c3"]


def test_compaction_keeps_folders_order_and_text(spark, tmp_path, database):
    name = f"{database}.t"
    rows = generation(spark, 1).repartition(20)
    PB.publish(rows.select("id", "g", "p"), name, str(tmp_path / "t"), ["p"], ["id"])
    before = PB.current(spark, name)
    assert PB.compact(spark, name) == 1
    assert PB.current(spark, name) != before
    got = spark.table(name)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.select("id", "g", "p").collect()))
    assert {r.p for r in got.select("p").distinct().collect()} == {"00", "01", "02", "03"}
    folder = tmp_path / "t" / PB.current(spark, name).rpartition(".")[2]
    files = sorted(folder.rglob("*.parquet"))
    assert {f.parent.name for f in files} == {"p=00", "p=01", "p=02", "p=03"} and len(files) == 4
    ids = [r.id for r in spark.read.parquet(str(files[0])).collect()]
    assert ids == sorted(ids)
    plan = spark.table(name).filter("p = '01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_path_compaction_keeps_folders_and_order(spark, tmp_path):
    src, dst = str(tmp_path / "many"), str(tmp_path / "few")
    generation(spark, 1).repartition(12).write.partitionBy("p").parquet(src)
    assert SK.folder_columns(spark, src) == ["p"]
    assert SK.optimize_table(spark, src, dst, sort_by=["id"]) == 1
    files = sorted((tmp_path / "few").rglob("*.parquet"))
    assert [f.parent.name for f in files] == ["p=00", "p=01", "p=02", "p=03"]
    ids = [r.id for r in spark.read.parquet(str(files[2])).collect()]
    assert ids == sorted(ids) and len(ids) == 500


# --------------------------------------------------------------------------- rejects
def test_fact_and_rejects_come_from_one_scan(spark, tmp_path, database):
    exp = spark.createDataFrame(
        [(2021, 1, c, "k", "1", "SP", "1", "7", 1.0, 2.0, 3.0) for c in ("1", "2", "x", None)]
        + [(None, 1, c, "k", "1", "SP", "1", "7", 1.0, 2.0, 3.0) for c in ("1", "y")], ", ".join(
            f"{c} {'int' if c in ('ano', 'mes') else 'double' if k > 7 else 'string'}"
            for k, c in enumerate(QG.S.EXP_COLUMNS)))
    imp = spark.createDataFrame([], ", ".join(f"{c} string" for c in QG.S.IMP_COLUMNS))
    flagged = G.flagged_fact(exp, imp)
    for lake in (P.Lake(str(tmp_path / "a")), P.Lake(str(tmp_path / "b"), database=database)):
        P._write_fact(spark, lake, flagged, lake.path("refined", "gold", P.FACT), ["rejeitada", "tipo_movimentacao"])
        report = {r["entidade"]: r for r in lake.report(spark).collect()}
        assert report[P.FACT]["linhas"] == 2 and report[P.REJECTS]["linhas"] == 4
        assert report[P.REJECTS]["mensagem"] == "sk_ncm_nulo: 3; sk_data_nulo: 2"
        fact, rejects = P.gold_table(spark, lake, P.FACT), P.gold_rejects(spark, lake)
        assert set(fact.columns) == set(G.build_fact(exp, imp).columns) and fact.count() == 2
        assert sorted(r["motivo"] for r in rejects.collect()) == [
            "sk_data_nulo", "sk_ncm_nulo", "sk_ncm_nulo", "sk_ncm_nulo,sk_data_nulo"]
    assert len(list((tmp_path / "a").rglob("rejeitada=*"))) == 2
    # the write reads each side once; a reader of the fact does not open the rejects
    assert flagged._jdf.queryExecution().executedPlan().toString().count("Scan") == 2
    read = P.gold_table(spark, P.Lake(str(tmp_path / "a")), P.FACT)
    assert "PartitionFilters: [isnotnull(rejeitada" in read._jdf.queryExecution().executedPlan().toString()


# --------------------------------------------------------------------------- catalogue
def test_estimates_are_within_their_error(spark):
    got = {(r["tabela"], r["coluna"]): r for r in QL.stored_catalogue(spark, SF_SMALL).collect()}
    for table in ("lineitem", "documents", "customer", "embeddings"):
        df = spark.read.parquet(f"{SF_SMALL}/{table}.parquet")
        cols = [c for t, c in got if t == table]
        exact = df.agg(*[F.count_distinct(F.xxhash64(F.when(F.col(c).isNotNull(), F.col(c)))).alias(c)
                         for c in cols]).first()
        for c in cols:
            assert abs(got[table, c]["distintos_aprox"] - exact[c]) <= max(1, 4 * C.ERROR * exact[c]), (table, c)


def test_a_month_is_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "cat")
    load = lambda rows: C.update(path, spark.createDataFrame(rows, "m string, x int, z double"), "t",
                                 F.col("m"))
    load([("2024-01", 1, 1.5), ("2024-01", 20, None), ("2024-02", 3, -2.25)])
    load([("2024-02", 4, 10.0), ("2024-02", 5, 9.0), ("2024-03", None, None)])
    got = {r["coluna"]: r for r in C.catalogue(spark, path).collect()}
    assert (got["x"]["linhas"], got["x"]["nulos"], got["x"]["minimo"], got["x"]["maximo"]) == (5, 1, "1", "20")
    assert (got["z"]["nulos"], got["z"]["minimo"], got["z"]["maximo"]) == (2, "1.500000", "10.000000")
    assert got["x"]["distintos_aprox"] == 4 and got["m"]["distintos_aprox"] == 3


# --------------------------------------------------------------------------- mappings over time
def test_ranges_and_months(spark):
    mapping = spark.createDataFrame(
        [("a", "x", 1, "2020-01-01"), ("a", "y", 2, "2020-03-15"), ("a", "w", 1, "2020-03-20"), ("a", "z", 3, "2022-01-01"),
         ("b", "q", 1, "2021-06-01")], "k string, s string, v int, d string").withColumn("d", F.to_date("d"))
    ranges = V.validity_ranges(mapping, "k", "d", "v")
    rows = spark.createDataFrame([(k, m) for k in "abc" for m in (
        201912, 202001, 202003, 202004, 202112, 202201, 202212)], "k string, m long")
    joined = V.valid_in_month(rows, ranges, "k", "m", ["s"], 2019, 2022)
    got = {(r.k, r.m): r.s for r in joined.collect()}
    assert [got["a", m] for m in (201912, 202001, 202003, 202004, 202112, 202201, 202212)] == [
        None, "x", "x", "y", "y", "z", "z"]
    assert [got["b", m] for m in (202004, 202112, 202212)] == [None, "q", "q"] and got["c", 202112] is None
    assert joined.count() == rows.count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_sector_report_has_both_versions_and_no_nested_loop(spark):
    report = QL.q_mart_sectors(spark, SF_SMALL)
    sectors = {r["setor_economico"] for r in report.collect()}
    assert any(s.startswith("NOVO ") for s in sectors) and any(not s.startswith("NOVO ") for s in sectors)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_current_activities_of_a_day(spark):
    mapping = spark.createDataFrame(
        [("1", "c", "d", "old", 1, "2020-01-01"), ("1", "c", "d", "new", 2, "2023-01-01"), ("2", "c", "d", "later", 1, "2030-01-01")],
        "codigo_ncm string, cnae string, descricao_cnae string, setor_economico string, versao int, v string").select(
        "*", F.to_date("v").alias("vigente_desde"))
    on = lambda day: {r["codigo_ncm"]: r["setor_economico"] for r in Q.current_activities(mapping, day).collect()}
    assert on("2022-12-31") == {"1": "old"} and on("2030-01-01") == {"1": "new", "2": "later"}


# --------------------------------------------------------------------------- subtotals
def test_subtotals_of_a_month_do_not_depend_on_others(spark):
    fact = QG.stored(spark, SF_SMALL)["ft_balanco_comercial"]
    one = fact.filter("sk_data = 199803")
    alone = M.trade_subtotals(one).collect()
    whole = M.trade_subtotals(fact).filter("sk_data = 199803").collect()
    assert sorted(map(str, alone)) == sorted(map(str, whole)) and alone


# --------------------------------------------------------------------------- layouts that joins use
def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_report_of_some_years_reads_their_folders(spark):
    g = QG.stored(spark, SF_SMALL)
    fact = QL.fact_by_year(spark, g["ft_balanco_comercial"])
    report = M.mart_years(fact, g["dim_data"], 1998, 1998)
    assert report._jdf.queryExecution().toString().count("dynamicpruningexpression(ano_ref") or (
        "dynamicpruning#" in report._jdf.queryExecution().optimizedPlan().toString())
    assert {r["ano"] for r in report.collect()} == {1998}


def test_bucketed_tables_join_without_a_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        places, firms = QL.bucketed_registry(spark, SF_SMALL)
        joined = M.establishment_distribution(places, firms, QG.S.cnaes(spark, SF_SMALL), QG.S.ACTIVE_STATUS)
        plan = _plan(joined)
        at = plan.index("SortMergeJoin [cnpj_basico")
        below = plan[at:].split("HashAggregate(keys=[c_mktsegment")[0].split("Exchange hashpartitioning(cnae")[0]
        assert "Exchange" not in below and below.count("Bucketed: true") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_vocation_of_a_state_reads_its_folder(spark):
    plan = _plan(QG.q_mart_state_vocation(spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(uf" in plan and "Join" not in plan
