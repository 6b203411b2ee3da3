"""Plan checks: the physical plans the design relies on."""

import contextlib
import io

from conftest import SF_SMALL
import __spark_entry__ as E
from tradestar.operators import gold as G
from tradestar.operators import marts as M
from tradestar.plans import q_gold as QG
from tradestar.sources import standins as S


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_fixed_size_tables_are_broadcast_and_filters_pushed(spark):
    p = plan(S.exports(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,O)" in p


def test_scans_read_only_needed_columns(spark):
    p = plan(G.build_dim_date(S.exports(spark, SF_SMALL), S.imports(spark, SF_SMALL)))
    lineitem_schema = [line for line in p.splitlines()
                       if "ReadSchema" in line and "l_shipdate" in line]
    assert lineitem_schema and "l_extendedprice" not in lineitem_schema[0]


def test_marts_aggregate_before_joining(spark):
    p = plan(M.mart_monthly_balance(QG.fact_of(spark, SF_SMALL), QG.dim_date_of(spark, SF_SMALL),
                                    1998))
    assert "partial_sum" in p
    # the fact is reduced per month key before it meets the date dimension
    first_agg = p.index("HashAggregate")
    assert first_agg < p.rindex("Join")


def test_top_k_is_take_ordered(spark):
    p = plan(E.queries()["mart_top_products"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_no_python_in_query_plans(spark):
    for key in ["fact_unified", "mart_monthly_balance", "silver_clean", "resolve_layout",
                "sniff_delimiter", "fk_orphans", "establishment_distribution"]:
        p = plan(E.queries()[key](spark, SF_SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
            assert node not in p, (key, node)


def test_dedup_is_two_phase_aggregate_not_window(spark):
    p = plan(QG.dim_product_of(spark, SF_SMALL))
    assert "Window" not in p
    assert "partial_min" in p          # map-side reduction before the shuffle


def test_marts_prune_movement_partitions_and_push_month_range(spark):
    p = plan(E.queries()["mart_top_products"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(tipo_movimentacao" in p
    assert "(tipo_movimentacao" in p and "= EXPORTACAO)]" in p
    assert "GreaterThanOrEqual(sk_data,199801), LessThanOrEqual(sk_data,199812)" in p


def test_gold_fact_files_stay_clustered_by_month(spark):
    """The partitioned write must not re-sort away the (sk_data, sk_ncm) order
    that makes row-group skipping work."""
    import glob

    import pyarrow.parquet as pq

    from tradestar.plans import trusted
    from tradestar.session import local_path

    root = local_path(trusted.materialize_gold(spark, SF_SMALL))
    files = glob.glob(f"{root}/ft_balanco_comercial/*/*.parquet")
    assert files
    for f in files:
        col = pq.read_table(f, columns=["sk_data"]).column(0).to_pylist()
        assert col == sorted(col), f


def _stored_again(spark, tmp_path, monkeypatch, conf):
    """The star of copied tables, stored with ``conf`` and 500 rows to a partition."""
    import shutil

    from tradestar import session
    from tradestar.plans import trusted
    from tradestar.session import local_path

    d = tmp_path / "sf"
    shutil.copytree(SF_SMALL, d)
    monkeypatch.setattr(session, "ROWS_PER_PARTITION", 500, raising=False)
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        gold = trusted.materialize_gold(spark, str(d))
        held = {k: spark.conf.get(k) for k in conf}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return local_path(trusted.materialize(spark, str(d))), local_path(gold), held


def _tasks(folder) -> int:
    import glob

    return len({f.rsplit("/", 1)[1].split("-")[1] for f in glob.glob(f"{folder}/*/*.parquet")})


#: Every shuffled partition as dealt out, and joins by shuffles only.
AS_DEALT = {"spark.sql.shuffle.partitions": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}


def test_stored_tables_are_cut_by_rows_not_by_the_sessions_number(spark, tmp_path, monkeypatch):
    """With the session's two partitions a task would sort half the table."""
    trusted_root, gold_root, held = _stored_again(spark, tmp_path, monkeypatch, AS_DEALT)
    assert _tasks(f"{trusted_root}/trade") >= 12       # 6,000 records, 500 to a partition
    assert _tasks(f"{gold_root}/ft_balanco_comercial") >= 10
    assert held == AS_DEALT                            # the session's settings hold again
    same = lambda a, b: a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    fact = spark.read.parquet(f"{gold_root}/ft_balanco_comercial")
    assert same(fact.select(*sorted(fact.columns)),
                QG.fact_of(spark, SF_SMALL).select(*sorted(fact.columns)))


def test_trade_records_are_written_by_the_joins_own_tasks(spark, tmp_path, monkeypatch):
    """No shuffle of the joined rows only to size the files."""
    import shutil

    from pyspark.sql import DataFrameWriter

    from tradestar.plans import trusted

    plans = []
    write = DataFrameWriter.partitionBy
    monkeypatch.setattr(DataFrameWriter, "partitionBy",
                        lambda self, *cols: plans.append(plan(self._df)) or write(self, *cols))
    shutil.copytree(SF_SMALL, tmp_path / "sf")
    trusted.materialize(spark, str(tmp_path / "sf"))
    assert len(plans) == 1 and "Join" in plans[0] and "REBALANCE" not in plans[0]
