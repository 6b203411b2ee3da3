"""Golden values from the data dictionary and pure name rules."""

import itertools
import string

from pyspark.sql import functions as F

from tradestar.functions import keys as K
from tradestar.functions.names import (fallback_name, header_clashes, header_names, partition_columns,
                                       names_by_position, plain_name, rename_positional_names)


def test_state_key_golden(spark):
    row = spark.createDataFrame([("SP",), (None,)], "uf string").select(
        K.state_key("uf").alias("k"), K.state_key_or_unknown("uf").alias("k2")).collect()
    assert row[0]["k"] == 8380 and row[0]["k2"] == 8380
    assert row[1]["k"] is None and row[1]["k2"] == 8888


def test_state_key_injective_on_two_letters(spark):
    codes = ["".join(p) for p in itertools.product(string.ascii_uppercase, repeat=2)]
    df = spark.createDataFrame([(c,) for c in codes], "uf string").select(
        K.state_key("uf").alias("k"))
    assert df.distinct().count() == len(codes)


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(2024, 1), (2024, 12), (2021, 13), (None, 3), (1998, 7)],
                               "ano int, mes int")
    rows = df.select(K.month_key("ano", "mes").alias("sk"), K.first_of_month("ano", "mes").alias("d"),
                     K.quarter("mes").alias("q"), K.semester("mes").alias("s"),
                     K.month_name("mes").alias("n")).collect()
    assert rows[0]["sk"] == 202401 and str(rows[0]["d"]) == "2024-01-01"
    assert (rows[0]["q"], rows[0]["s"], rows[0]["n"]) == (1, 1, "Janeiro")
    assert (rows[1]["q"], rows[1]["s"], rows[1]["n"]) == (4, 2, "Dezembro")
    assert rows[2]["d"] is None and rows[2]["n"] == "Desconhecido"
    assert rows[3]["d"] is None and rows[3]["sk"] is None
    assert rows[4]["n"] == "Julho"


def test_surrogate_key_keeps_value_and_nulls_garbage(spark):
    rows = spark.createDataFrame([("01012100",), ("N/A",), (None,)], "c string").select(
        K.surrogate_key("c").alias("k")).collect()
    assert [r["k"] for r in rows] == [1012100, None, None]


def test_name_rules():
    assert plain_name(" Código País ") == "codigo_pais"
    assert plain_name("Região-Chave") == "regiao_chave"
    assert header_names(["Código", "codigo", "codigo_2", "CODIGO"]) == ["codigo", "codigo_3", "codigo_2", "codigo_4"]
    assert header_clashes(["Código", "x", "codigo"]) == [("codigo", "codigo_2")]
    assert fallback_name("NCM Código") == "ncm_código"
    assert names_by_position(["a", "b"], 4) == (["a", "b", "_c2", "_c3"], [], ["_c2", "_c3"])
    assert names_by_position(["a", "b", "c"], 2) == (["a", "b"], ["c"], [])
    assert rename_positional_names(["x", "y", "z"], ["a"]) == ["a", "y", "z"]
    assert partition_columns(["CO_ANO", "x", "mes", "co_mes"]) == ["CO_ANO", "mes"]
    assert partition_columns(["x"]) == []


def test_null_if_sentinel(spark):
    rows = spark.createDataFrame([("N/A",), ("SP",)], "u string").select(
        K.null_if_sentinel(F.col("u"), ("N/A",)).alias("u")).collect()
    assert [r["u"] for r in rows] == [None, "SP"]


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _NoContextSession:
    """A session without a SparkContext (as on Spark Connect)."""
    def __init__(self, values):
        self.conf = _Conf(values)

    @property
    def sparkContext(self):
        raise RuntimeError("no context")


def test_checkpoint_root_rules():
    from tradestar.session import checkpoint_root
    shared = _NoContextSession({"spark.master": "yarn", "spark.checkpoint.dir": "/shared/ckpt"})
    assert checkpoint_root(shared) == "/shared/ckpt"      # the cluster's setting wins
    unset = _NoContextSession({"spark.master": "yarn", "spark.sql.warehouse.dir": "hdfs://lake/wh/"})
    assert checkpoint_root(unset) == "hdfs://lake/wh/_scratch"    # never a machine-local folder
