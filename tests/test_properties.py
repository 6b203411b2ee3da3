"""Properties of the chain and the marts on driver data."""

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tradestar.operators import marts as M
from tradestar.operators import silver as SV
from tradestar.plans import q_gold as QG
from tradestar.plans import q_silver as QS


def test_dedup_idempotent(spark):
    once = SV.dedup_rows(QS.order_profile(spark, SF_SMALL))
    assert SV.dedup_rows(once).count() == once.count()


def test_silver_chain_idempotent_with_fill_first(spark):
    once = SV.silver_clean(QS.dirty_orders(spark, SF_SMALL), fill_first=True)
    twice = SV.silver_clean(once, fill_first=True)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_balance_equals_exports_minus_imports(spark):
    fact = QG.fact_of(spark, SF_SMALL)
    k = M.kpi_monthly(fact, QG.dim_date_of(spark, SF_SMALL)).agg(
        F.sum("exportacao").alias("e"), F.sum("importacao").alias("i"),
        F.sum("saldo").alias("s")).first()
    totals = {r["tipo_movimentacao"]: r["v"] for r in
              fact.groupBy("tipo_movimentacao").agg(F.sum("valor_fob").alias("v")).collect()}
    assert k["s"] == k["e"] - k["i"]
    assert k["e"] == totals["EXPORTACAO"] and k["i"] == totals["IMPORTACAO"]


def test_fact_rows_equal_inputs_minus_rejects(spark):
    e, i = QG.exp_imp(spark, SF_SMALL)
    from tradestar.plans import q_quality as QQ
    pe, pi = QQ._plant(e), QQ._plant(i)
    from tradestar.operators import gold as G
    from tradestar.operators import quality as Q
    fact = G.build_fact(pe, pi).count()
    rejects = Q.fact_rejects(pe, pi)
    dropped = rejects.filter(F.col("motivo").contains("nulo")).count()
    assert fact == pe.count() + pi.count() - dropped


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", " a", "A ", None]),
                          st.one_of(st.none(), st.integers(0, 3))), max_size=30))
def test_silver_clean_matches_python_model(spark, rows):
    df = spark.createDataFrame(rows, "s string, n int")
    got = sorted(map(tuple, SV.silver_clean(df).collect()), key=repr)
    seen = {((r[0].strip().upper() if r[0] is not None else None), r[1]) for r in rows}
    want = sorted({(s if s is not None else "N/A", n if n is not None else 0) for s, n in seen}
                  | set(), key=repr)
    # dedup runs before the fill (reference order): rows equal only after the
    # fill stay separate, so compare as multisets of the filled distinct rows
    filled = sorted(((s if s is not None else "N/A", n if n is not None else 0) for s, n in seen),
                    key=repr)
    assert got == filled
    assert set(got) == set(want)


def test_decimal_sums_are_exact(spark):
    df = spark.createDataFrame([(Decimal("0.10"),)] * 10, "v decimal(18,2)")
    assert df.agg(F.sum("v")).first()[0] == Decimal("1.00")


def test_hot_key_dedup_and_orphans(spark):
    """A third of the rows share one key: results stay exact."""
    from tradestar.operators import gold as G
    from tradestar.operators import quality as Q
    n = 3000
    rows = [(-1 if i % 3 == 0 else i, f"v{i:05d}") for i in range(n)]
    df = spark.createDataFrame(rows, "k long, v string")
    out = {r["k"]: r["v"] for r in G.dedup_by_key(df, "k").collect()}
    assert out[-1] == "v00000" and len(out) == len({k for k, _ in rows})
    fact = spark.createDataFrame([(k,) for k, _ in rows], "sk long")
    dim = spark.createDataFrame([(k,) for k in range(n)], "sk long")
    res = Q.fk_orphans(fact, {"sk": (dim, "sk")}).first()
    assert res["linhas_orfas"] == n // 3 and res["chaves_orfas"] == 1


def test_sentinels_unknown_member_and_defaults(spark):
    """B8/B20: 'N/A' read as missing; the unknown state closes the 8888 orphan."""
    from tradestar.operators import gold as G
    via = spark.createDataFrame([("1", "N/A"), ("N/A", "X")], "codigo_via_transporte string, "
                                "descricao_via_transporte string")
    rows = {r["codigo_via"]: r["nome_via"] for r in G.build_dim_transport(via, ("N/A",)).collect()}
    assert rows == {"1": "Via não informada", None: "X"}
    exp = spark.createDataFrame([(2021, 1, "01012100", "063", "N/A", "1", "1.00", "1", "1")],
                                "ano int, mes int, codigo_ncm string, codigo_pais_destino string, "
                                "uf_origem string, codigo_via_transporte string, "
                                "valor_fob_usd string, quantidade_estatistica string, "
                                "peso_liquido_kg string")
    imp = exp.withColumnsRenamed({"codigo_pais_destino": "codigo_pais_origem",
                                  "uf_origem": "uf_destino"}).limit(0)
    fact = G.build_fact(exp, imp, sentinels=("N/A",)).first()
    assert fact["sk_geografia_uf"] == 8888
    pais = spark.createDataFrame([("063", "ARG", "Argentina")],
                                 "codigo_pais string, codigo_pais_iso3 string, nome_pais_pt string")
    bloc = spark.createDataFrame([], "codigo_pais string, nome_bloco_pt string")
    geo = G.build_dim_geography(pais, bloc, exp, imp, sentinels=("N/A",), unknown_member=True)
    keys = {r["sk_geografia"] for r in geo.collect()}
    assert 8888 in keys and 7847 not in keys          # no geography row for "N/A"
