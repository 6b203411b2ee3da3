"""Run-to-completion streams: idempotent reruns, incremental files and an
idempotent per-batch callback under retry."""

import pytest
from pyspark.sql import functions as F

from tradestar.layouts import source_schema
from tradestar.sources.files import LANDING_OPTIONS, project_by_mapping
from tradestar.layouts import TRADE_LAYOUTS
from tradestar.streaming import ingest as ST

HEADER = "CO_ANO;CO_MES;CO_NCM;CO_UNID;CO_PAIS;SG_UF_NCM;CO_VIA;CO_URF;QT_ESTAT;KG_LIQUIDO;VL_FOB"


def _file(path, rows):
    path.write_bytes(("\n".join([HEADER, *rows]) + "\n").encode("ISO-8859-1"))


def _rows(n, year):
    return [f"{year};{m % 12 + 1};0101210{m % 10};10;063;SP;1;0817600;1;2;{m}.50" for m in range(n)]


def _run(spark, src, out):
    stream = ST.file_stream(spark, str(src), source_schema("EXPO_2021"), "csv",
                            "EXP_[0-9][0-9][0-9][0-9].csv", LANDING_OPTIONS)
    ST.run_available_now(stream, str(out / "data"), str(out / "_ckpt"),
                         transform=lambda df: project_by_mapping(df, TRADE_LAYOUTS["EXPO_2021"]))
    return spark.read.parquet(str(out / "data"))


def test_available_now_is_incremental_and_idempotent(spark, tmp_path):
    src, out = tmp_path / "src", tmp_path / "out"
    src.mkdir()
    _file(src / "EXP_2020.csv", _rows(5, 2020))
    _file(src / "EXP_2021.csv", _rows(7, 2021))
    _file(src / "EXP_2021_MUN.csv", _rows(3, 2021))      # not matched by the glob
    assert _run(spark, src, out).count() == 12
    assert _run(spark, src, out).count() == 12           # nothing new, nothing added
    _file(src / "EXP_2022.csv", _rows(4, 2022))
    df = _run(spark, src, out)
    assert df.count() == 16
    assert df.filter(F.col("ano") == 2022).count() == 4
    assert df.schema["codigo_ncm"].dataType.simpleString() == "string"


def test_foreach_batch_retry_does_not_duplicate(spark, tmp_path):
    src, out = tmp_path / "src", tmp_path / "out"
    src.mkdir()
    _file(src / "EXP_2020.csv", _rows(10, 2020))
    target = str(out / "data")
    writer = ST.idempotent_batch_writer(target)
    calls = {"n": 0}

    def flaky(batch_df, batch_id):
        writer(batch_df, batch_id)
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("failure after the write")

    def stream():
        return ST.file_stream(spark, str(src), source_schema("EXPO_2021"), "csv",
                              "EXP_*.csv", LANDING_OPTIONS)

    with pytest.raises(Exception):
        ST.run_foreach_batch(stream(), str(out / "_ckpt"), flaky)
    ST.run_foreach_batch(stream(), str(out / "_ckpt"), flaky)   # the batch is retried
    assert spark.read.parquet(target).count() == 10


def test_schema_evolution_on_restart(spark, tmp_path):
    """T3: a restart with a wider explicit schema picks up new files only;
    the sink is read back with schema merge."""
    from pyspark.sql import types as T
    src, out = tmp_path / "src", tmp_path / "out"
    src.mkdir()
    (src / "a.csv").write_text("k;v\n1;x\n2;y\n")
    narrow = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])
    ST.run_available_now(ST.file_stream(spark, str(src), narrow, "csv", "*.csv", LANDING_OPTIONS),
                         str(out / "data"), str(out / "_ckpt"))
    (src / "b.csv").write_text("k;v;w\n3;z;extra\n")
    wide = T.StructType(narrow.fields + [T.StructField("w", T.StringType())])
    n = ST.run_available_now(ST.file_stream(spark, str(src), wide, "csv", "*.csv",
                                            LANDING_OPTIONS),
                             str(out / "data"), str(out / "_ckpt"))
    assert n == 1                                            # only the new file
    back = spark.read.option("mergeSchema", "true").parquet(str(out / "data"))
    rows = {r["k"]: r["w"] for r in back.collect()}
    assert rows == {"1": None, "2": None, "3": "extra"}


def test_rows_of_many_batches_are_counted_as_they_end(spark, tmp_path):
    """Two numbers for a query, whatever the number of its batches."""
    src = tmp_path / "src"
    src.mkdir()
    for k in range(12):
        _file(src / f"EXP_20{k:02d}.csv", _rows(k + 1, 2000 + k))
    one = {**LANDING_OPTIONS, "maxFilesPerTrigger": "1"}
    stream = ST.file_stream(spark, str(src), source_schema("EXPO_2021"), "csv", "EXP_*.csv", one)
    seen = []
    with ST.listening(spark) as listener:
        assert ST.run_foreach_batch(stream, str(tmp_path / "c"), lambda df, k: seen.append(df.count())) == 78
    assert sorted(seen) == list(range(1, 13))
    assert sorted(listener.rows.values()) == [78] and sorted(listener.batches.values()) == [12]
    assert ST.run_foreach_batch(stream, str(tmp_path / "c"), lambda df, k: seen.append(df.count())) == 0


def test_each_query_has_its_own_rows(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    for k in (1, 2, 3):
        (tmp_path / f"s{k}").mkdir()
        _file(tmp_path / f"s{k}" / "EXP_2020.csv", _rows(10 * k, 2020))

    def run(k):
        stream = ST.file_stream(spark, str(tmp_path / f"s{k}"), source_schema("EXPO_2021"), "csv", "EXP_*.csv",
                                LANDING_OPTIONS)
        return ST.run_available_now(stream, str(tmp_path / f"d{k}"), str(tmp_path / f"c{k}"))

    with ThreadPoolExecutor(3) as pool:
        assert list(pool.map(run, (1, 2, 3))) == [10, 20, 30]
