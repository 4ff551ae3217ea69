"""The whole lake built from raw files: counts agree, missing inputs are skipped, reruns change nothing."""

import os
import shutil

import pytest

from carelake.plans import jobs, refresh
from carelake.plans.roles import Tables
from carelake.schemas import RAW
from carelake.sources.sinks import write_partitioned

FOLDER = "/root/testdata/sf0.001"


def test_missing_inputs_are_skipped(spark, tmp_path):
    assert set(jobs.build_all(spark, str(tmp_path)).values()) == {0}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")
def test_lake_build(spark, tmp_path):
    root = str(tmp_path)
    t = Tables(spark, FOLDER)
    stamp = {"uf": "'RS'", "ano": "'1998'", "mes": "'01'"}
    for source, role in (("sih_rd", "raw_admission"), ("cnes_lt", "raw_bed"), ("sim_do", "raw_death")):
        raw = t.role(role)
        raw = raw.select(*[raw[c].cast("string").alias(c) for c, _ in raw.dtypes]).selectExpr(
            "*", *[f"{e} as {n}" for n, e in stamp.items()]
        )
        write_partitioned(raw, f"{root}/bronze/{source}", ["uf", "ano", "mes"])
    population = tmp_path / "pop.csv"
    population.write_text("cod6,cod7,nome,populacao\n430000,4300000,A,1000\n")
    first = jobs.build_all(spark, root, str(population))
    assert first["sih_rd"] == t.role("raw_admission", "N_AIH").where("N_AIH is not null").count()
    assert first["cnes_st"] == 0
    assert all(first[k] > 0 for k in first if k != "cnes_st")
    assert jobs.build_all(spark, root, str(population)) == first
    for table in jobs.BUILDERS:
        assert spark.read.parquet(f"{root}/gold/{table}").count() == first[table]
    beds = spark.read.parquet(f"{root}/gold/leitos_municipio_mes")
    assert beds.where("populacao is not null").count() > 0
    panel = spark.read.parquet(f"{root}/gold/hospital_panel_cid_mes")
    assert "codufmun_hosp" in panel.columns


def _files(root, table):
    found = {}
    for folder, _, names in os.walk(f"{root}/gold/{table}"):
        for name in names:
            if name.startswith("part-"):
                found.setdefault(folder.split(table)[1], set()).add(name)
    return found


def _rows(spark, path):
    df = spark.read.parquet(path)
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def _admissions(spark, month, n, stray=None):
    """n admissions of a raw month; `stray` of them carry that month instead."""
    return spark.range(n).selectExpr(
        *[f"cast(null as string) as {k}" for k in RAW["sih_rd"].fieldNames() if k not in ("N_AIH", "ANO_CMPT", "MES_CMPT", "DIAG_PRINC", "MUNIC_RES", "CNES", "MORTE", "DIAS_PERM")],
        "cast(id as string) as N_AIH", "'2024' as ANO_CMPT",
        f"case when id < 3 then '{stray or month}' else '{month}' end as MES_CMPT",
        "'J180' as DIAG_PRINC", "'430010' as MUNIC_RES", "cast(id % 4 as string) as CNES", "cast(id % 2 as string) as MORTE", "'3' as DIAS_PERM",
    )


def _deaths(spark, n):
    given = {"DTOBITO": "lpad(cast(1 + id % 28 as string), 2, '0') || '022024'", "CAUSABAS": "'J189'", "CODMUNRES": "'430010'", "LOCOCOR": "'1'", "TIPOBITO": "'2'"}
    return spark.range(n).selectExpr(*[f"{given.get(k, 'cast(null as string)')} as {k}" for k in RAW["sim_do"].fieldNames()])


def test_refresh_rebuilds_only_touched_months(spark, tmp_path):
    root = str(tmp_path / "lake")
    for month in (1, 2, 3):
        refresh.load_raw(spark, root, _admissions(spark, month, 20 + month), "sih_rd", "RS", 2024, month, "v1")
    refresh.load_raw(spark, root, _deaths(spark, 9), "sim_do", "RS", 2024, 2, "v1")
    first = refresh.refresh(spark, root)
    assert first["sih_rd"] == 3 and first["continuum_cid_mes"] == 3
    assert refresh.refresh(spark, root) == {}
    before = {t: _files(root, t) for t in refresh.INPUTS}
    # The second month is delivered anew; three of its rows belong to the third.
    refresh.load_raw(spark, root, _admissions(spark, 2, 40, stray=3), "sih_rd", "RS", 2024, 2, "v2")
    again = refresh.refresh(spark, root)
    assert again["sih_rd"] == 2 and again["mortalidade_municipio_competencia"] == 2
    for table in ("continuum_cid_mes", "hospital_panel_cid_mes"):
        now = _files(root, table)
        assert now["/ano=2024/mes=1"] == before[table]["/ano=2024/mes=1"]
        assert now["/ano=2024/mes=2"] != before[table]["/ano=2024/mes=2"]
    # Delivered once more without the stray rows, then with nothing: both months follow.
    for version, rows in (("v3", _admissions(spark, 2, 5)), ("v4", _admissions(spark, 2, 0))):
        refresh.load_raw(spark, root, rows, "sih_rd", "RS", 2024, 2, version)
        refresh.refresh(spark, root)
        whole = str(tmp_path / version)
        shutil.copytree(f"{root}/bronze", f"{whole}/bronze")
        jobs.build_all(spark, whole)
        for table in ("continuum_cid_mes", "hospital_panel_cid_mes", "mortalidade_municipio_competencia"):
            assert _rows(spark, f"{root}/gold/{table}") == _rows(spark, f"{whole}/gold/{table}"), (version, table)
    assert spark.read.parquet(f"{root}/silver/sih_rd").where("mes = 2").count() == 0
