"""Readers and writers over files."""

import json

import pytest
from pyspark.sql import functions as F

from carelake import session
from carelake.schemas import RAW
from carelake.sources import readers, sinks
from carelake.sources.reference import POSTCODE_RANGES

c = F.col


def test_union_by_name_survives_type_drift(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1, "x")], "CNES int, EXTRA string").write.parquet(a)
    spark.createDataFrame([("0002", "201")], "cnes string, CODUFMUN string").write.parquet(b)
    out = readers.read_union(spark, [a, b], RAW["cnes_lt"])
    assert {(r.CNES, r.CODUFMUN) for r in out.collect()} == {("1", None), ("0002", "201")}


def test_partition_replace_leaves_others_alone(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(5).withColumn("v", c("id").cast("string"))
    path, rows = sinks.replace_partition(df, root, "sih_rd", "RS", 2024, 1)
    assert rows == 5 and path.endswith("sih_rd/uf=RS/ano=2024/mes=01")
    sinks.replace_partition(df, root, "sih_rd", "RS", 2024, 2)
    assert sinks.replace_partition(df.limit(2), root, "sih_rd", "RS", 2024, 1)[1] == 2
    stored = spark.read.parquet(f"{root}/sih_rd")
    assert {(r.mes, r["count"]) for r in stored.groupBy("mes").count().collect()} == {(1, 2), (2, 5)}


def test_empty_loads(spark, tmp_path):
    root = str(tmp_path / "bronze")
    df = spark.range(5).withColumn("v", F.lit("x"))
    path, _ = sinks.replace_partition(df, root, "sih_rd", "RS", 2024, 1)
    for empty in (df.where("false"), spark.createDataFrame([], df.schema), df.where("id < 0")):
        sinks.replace_partition(df, root, "sih_rd", "RS", 2024, 1)
        assert sinks.replace_partition(empty, root, "sih_rd", "RS", 2024, 1) == (path, 0)
        assert spark.read.parquet(path).count() == 0
    none = spark.createDataFrame([], "source string, uf string, competencia string")
    assert sinks.mark_completed(spark, str(tmp_path / "ledger"), none) == 0


def test_ledger_marks_once(spark, tmp_path):
    path = str(tmp_path / "ledger")
    done = spark.createDataFrame([("s", "RS", "2024-01"), ("s", "RS", "2024-01")], sinks.LEDGER)
    assert sinks.mark_completed(spark, path, done) == 1
    assert sinks.mark_completed(spark, path, done) == 0
    assert sinks.read_or_empty(spark, path, sinks.LEDGER).count() == 1


def test_census_json(spark, tmp_path):
    series = [
        {"localidade": {"id": "4300109", "nome": "Agudo - RS"}, "serie": {"2022": "16041"}},
        {"localidade": {"id": "4300208", "nome": "Ajuricaba - RS"}, "serie": {"2022": "-"}},
        {"localidade": {"id": "43", "nome": "curto"}, "serie": {"2022": "5"}},
    ]
    path = tmp_path / "pop.json"
    path.write_text(json.dumps([{"resultados": [{"series": series}]}], indent=1))
    assert [tuple(r) for r in readers.read_census(spark, str(path)).collect()] == [
        ("430010", "4300109", "Agudo", 16041)
    ]


def test_latin1_neighbourhoods(spark, tmp_path):
    path = tmp_path / "bairros.csv"
    lines = [
        "População por bairro;;", "Bairro;População;%", "Três Figueiras;3.456;0,26", "Passo da Areia;24.000;1,80", "Vazio;;0,00",
        "Total;62.448;100", "Porto Alegre;1;1", "Ruim;x1;2", ";5;1",
    ]
    path.write_bytes("\r\n".join(lines).encode("latin-1"))
    rows = [tuple(r) for r in readers.read_neighbourhood_census(spark, str(path)).collect()]
    assert rows == [
        ("Três Figueiras", 3456, 0.26, "tres figueiras"), ("Passo D'Areia", 24000, 1.8, "passo d'areia"),
        ("Vazio", 0, 0.0, "vazio"),
    ]


def test_development_index(spark, tmp_path):
    path = tmp_path / "idh.csv"
    path.write_text("UF;ANO;Codmun6;Município;IDHM;X\n43;2010;430010;Agudo; 0,694;1\n42;2010;420010;Y;0,7;1\n43;2000;430010;Agudo;0,5;1\n")
    out = readers.read_development_index(spark, str(path))
    assert out.columns == ["cod6", "nome", "idhm"]
    assert [tuple(r) for r in out.collect()] == [("430010", "Agudo", "0.694")]


def test_population_codes_stay_text(spark, tmp_path):
    path = tmp_path / "pop.csv"
    path.write_text("cod6,cod7,nome,populacao\n030010,0300109,Agudo,16041\n")
    assert tuple(readers.read_population(spark, str(path)).first()) == ("030010", "0300109", "Agudo", 16041)


def test_first_listed_range_wins(spark):
    rows = [(i, lo, hi, name) for i, (lo, hi, name) in enumerate(POSTCODE_RANGES)]
    lookup = readers.expand_ranges(
        spark.createDataFrame(rows, "ordem int, cep_min string, cep_max string, bairro string")
    )
    expected = {}
    for lo, hi, name in POSTCODE_RANGES:
        for p in range(int(lo), int(hi) + 1):
            expected.setdefault(f"{p:05d}", name)
    assert {r.cep_prefix: r.bairro for r in lookup.collect()} == expected


def test_period_from_the_first_row_of_each_file(spark, tmp_path):
    for i, period in enumerate(("202401", "202402")):
        spark.createDataFrame([(period,), ("199901",)], "COMPETEN string").coalesce(1).write.parquet(f"{tmp_path}/f{i}")
    files = spark.read.parquet(f"{tmp_path}/f0", f"{tmp_path}/f1")
    assert {(r.ano, r.mes) for r in readers.infer_period(files, "cnes").collect()} == {(2024, 1), (2024, 2)}
    assert {(r.ano, r.mes) for r in readers.infer_period(files, "sih").collect()} == {(2026, 2)}
    spark.createDataFrame([], "COMPETEN string").coalesce(1).write.parquet(f"{tmp_path}/f2")
    spark.createDataFrame([(2023, 11)], "ANO int, MES int").write.parquet(f"{tmp_path}/f3")
    found = lambda source: sorted((r.ano, r.mes) for r in readers.infer_folder_periods(spark, str(tmp_path), source).collect())
    assert set(found("cnes")) == {(2024, 1), (2024, 2), (2026, 2)} and len(found("cnes")) == len(list(tmp_path.glob("f*/*.parquet")))
    assert (2023, 11) in found("sih") and (2026, 2) in found("sih")


def test_insert_or_ignore_keeps_the_first(spark, tmp_path):
    path, order = str(tmp_path / "store"), [c("ts")]
    schema = spark.createDataFrame([], "id string, ts int").schema
    first = spark.createDataFrame([("a", 2), ("a", 1), (None, 0)], schema)
    second = spark.createDataFrame([("a", 0), ("b", 5)], schema)
    for batch in (first, second, second):
        sinks.insert_or_ignore(batch, path, schema, "id", order, 8)
    assert {tuple(r) for r in spark.read.parquet(path).select("id", "ts").collect()} == {("a", 1), ("b", 5)}


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = session.shared_path(spark, "x"), session.shared_path(spark, "x")
    assert first != second
    if named:
        assert first.startswith(f"{named.rstrip('/')}/x-")


def test_layer_names_are_checked(spark):
    with pytest.raises(ValueError):
        sinks.write_layer(spark.range(1), "jdbc:x", "gold", "t", {})




def test_mixed_folder_is_read_by_layout(spark, tmp_path):
    root = str(tmp_path / "all files")
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, k string").repartition(2).write.parquet(f"{root}/x")
    spark.createDataFrame([("3", 1.5)], "id string, v double").write.parquet(f"{root}/y=1")
    spark.createDataFrame([("c", 4)], "k string, id long").write.parquet(f"{root}/z")
    found = {r.layout for r in readers.layouts(spark, root).collect()}
    assert found == {"id int64, k string", "id string, v double"}
    schema = "id long, k string, v double"
    got = readers.read_mixed(spark, root, spark.createDataFrame([], schema).schema)
    assert sorted(map(tuple, got.collect())) == [(1, "a", None), (2, "b", None), (3, None, 1.5), (4, "c", None)]
    assert str(got._jdf.queryExecution().optimizedPlan()).count("Relation [") == 2
    (tmp_path / "none").mkdir()
    assert readers.read_mixed(spark, str(tmp_path / "none"), got.schema).count() == 0
