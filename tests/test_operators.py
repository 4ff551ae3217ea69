"""Operators on small hand-made tables, against brute force where it matters."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.operators import dashboard, explore, gold, indicators, joins, linkage, ml, planning, profile
from carelake.operators.clean import apply_quality_rules, clean_admissions, clean_deaths
from carelake.operators.quantiles import exact_quantiles
from carelake.schemas import RAW, RAW_ADMISSIONS, RAW_DEATHS
from tests.helpers import column

c = F.col


def raw_row(columns, **values):
    return tuple(values.get(name) for name in columns)


def test_clean_admissions_sample_row(spark):
    row = raw_row(
        RAW_ADMISSIONS, N_AIH="4324104486889", CNES="2246767", ANO_CMPT="2024", MES_CMPT="06",
        DIAG_PRINC="O021", SEXO="3", IDADE="30", COD_IDADE="4", MUNIC_RES="431660", DT_INTER="20240621",
        DT_SAIDA="20240622", DIAS_PERM="1", MORTE="0", VAL_TOT="187.62",
    )
    missing = raw_row(RAW_ADMISSIONS, CNES="1")
    out = clean_admissions(spark.createDataFrame([row, missing], RAW["sih_rd"]))
    assert len(out.columns) == 31
    (got,) = out.collect()
    assert (got.n_aih, got.cnes, got.cid3, got.munic_res) == (4324104486889, "2246767", "O02", "431660")
    assert (got.competencia, got.dt_saida) == (date(2024, 6, 1), date(2024, 6, 22))
    assert (got.val_tot, got.uso_uti, got.faixa_etaria, got.csap_flag) == (187.62, 0, "30-44", False)


def test_clean_deaths_sample_row(spark):
    row = raw_row(
        RAW_DEATHS, CONTADOR="1", DTOBITO="01012024", IDADE="470", SEXO="1", CODMUNRES="430690",
        LOCOCOR="1", CODESTAB="2234432", CAUSABAS="C349",
    )
    out = clean_deaths(spark.createDataFrame([row, raw_row(RAW_DEATHS)], RAW["sim_do"]))
    assert len(out.columns) == 37
    (got,) = out.collect()
    assert (got.dt_obito, got.ano, got.mes, got.idade_anos) == (date(2024, 1, 1), 2024, 1, 70)
    assert (got.cid3, got.capitulo_cid, got.causa_externa, got.obito_hospitalar) == ("C34", "C", 0, 1)


def admissions(spark, rows):
    return spark.createDataFrame(
        rows,
        "cnes string, cid3 string, munic_res string, ano int, mes int, csap_flag boolean, morte int,"
        "dias_perm int, idade_anos int, val_tot double, uso_uti int",
    )


ROWS = [
    ("1", "J18", "430010", 2024, 1, True, 1, 4, 70, 10.10, 1),
    ("1", "J18", "430010", 2024, 1, True, 0, 6, 60, 20.20, 0),
    ("1", "J18", "430010", 2024, 1, None, None, None, None, None, 0),
    ("2", "I21", "430020", 2024, None, False, 0, 1, 50, 5.00, 0),
    ("2", None, "430020", 2024, 2, False, 1, 1, 50, 5.00, 0),
]


def test_cascade_full_join_keeps_both_sides(spark):
    deaths = spark.createDataFrame(
        [("J18", "430010", 2024, 1, 1), ("C34", "430030", 2024, 1, 0), ("I21", "430020", 2024, None, 1)],
        "cid3 string, munic_res string, ano int, mes int, obito_hospitalar int",
    )
    rows = {(r.cid3, r.mes, r.n_internacoes): r for r in gold.care_cascade(admissions(spark, ROWS), deaths).collect()}
    both = rows[("J18", 1, 3)]
    assert (both.n_internacoes_csap, both.n_mortes_hospital_sih, both.n_obitos_totais) == (2, 1, 1)
    assert both.custo_total == 30.30 and both.custo_medio == pytest.approx(15.15)
    assert both.perm_media == 5.0 and both.letalidade_hospitalar == pytest.approx(1 / 3)
    only_death = rows[("C34", 1, 0)]
    assert (only_death.n_obitos_totais, only_death.perm_media, only_death.custo_total) == (1, None, None)
    # A NULL month never meets another NULL month: the two sides stay apart.
    assert ("I21", None, 1) in rows and ("I21", None, 0) in rows
    assert len(rows) == 4


def test_cascade_without_deaths_has_the_same_columns(spark):
    adm = admissions(spark, ROWS)
    alone = gold.care_cascade(adm)
    deaths = spark.createDataFrame([], "cid3 string, munic_res string, ano int, mes int, obito_hospitalar int")
    assert alone.dtypes == gold.care_cascade(adm, deaths).dtypes


def test_panel_median_and_null_rules(spark):
    panel = gold.hospital_panel(admissions(spark, ROWS))
    j18 = panel.where("cid3 = 'J18'").first()
    assert (j18.n_internacoes, j18.n_mortes, j18.taxa_mortalidade) == (3, 1, 0.5)
    assert (j18.perm_media, j18.perm_mediana, j18.custo_total) == (5.0, 5.0, 30.30)
    assert j18.codufmun_hosp is None
    facilities = spark.createDataFrame(
        [("1", date(2024, 1, 1), "430010", "05", "M", "01"), ("1", date(2024, 2, 1), "430011", "07", "E", "01")],
        "cnes string, competencia date, codufmun string, tp_unid string, esfera string, clientela string",
    )
    with_facility = gold.hospital_panel(admissions(spark, ROWS), facilities)
    assert with_facility.where("cid3 = 'J18'").first().codufmun_hosp == "430011"
    assert sorted(with_facility.columns) == sorted(panel.columns)


def test_panel_median_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [
        (str(rng.randrange(3)), "A00", "43", 2024, 1, False, 0, rng.choice([None, *range(9)]), 1, 1.0, 0)
        for _ in range(400)
    ]
    got = {r.cnes: r.perm_mediana for r in gold.hospital_panel(admissions(spark, rows)).collect()}
    for cnes, median in got.items():
        assert median == np.median([r[7] for r in rows if r[0] == cnes and r[7] is not None])


def test_mortality_counts_unknown_outcomes(spark):
    row = gold.municipality_mortality(admissions(spark, ROWS)).where("cod6 = '430010'").first()
    # Percent of all admissions: an unknown outcome stays in the denominator.
    assert (row.internacoes, row.obitos) == (3, 1)
    assert row.taxa_mortalidade == pytest.approx(100 / 3)


def test_bed_capacity_guards_population(spark):
    beds = spark.createDataFrame(
        [("1", "430010", 2024, 1, "uti", 3, 5), ("2", "430010", 2024, 1, "hospital_dia", 2, 2),
         ("3", "430020", 2024, 1, "clinico", 4, 4), ("4", "430030", 2024, 1, "clinico", 4, 4)],
        "cnes string, codufmun string, ano int, mes int, categoria string, qt_sus int, qt_exist int",
    )
    pop = spark.createDataFrame([("430010", 1000), ("430020", 0)], "cod6 string, populacao int")
    rows = {r.codufmun: r for r in gold.bed_capacity(beds, pop).collect()}
    first = rows["430010"]
    assert (first.n_hospitais, first.leitos_sus_total, first.leitos_uti_sus) == (2, 5, 3)
    # Day-hospital beds are in the total only.
    assert sum(first[f"leitos_{k}_sus"] for k in gold.BED_COLUMNS) == 3
    assert first.leitos_sus_por_1000hab == 5.0
    assert rows["430020"].leitos_sus_por_1000hab is None and rows["430030"].populacao is None
    assert gold.bed_capacity(beds).columns == gold.bed_capacity(beds, pop).columns


def test_period_filter_prunes_years(spark, tmp_path):
    gold.care_cascade(admissions(spark, ROWS)).write.partitionBy("ano").parquet(str(tmp_path / "g"))
    stored = spark.read.parquet(str(tmp_path / "g"))
    ranked = dashboard.rank_codes(stored, date(2024, 1, 1), date(2024, 12, 1), "j")
    assert column(ranked, "cid3") == ["J18"]
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan


@pytest.mark.parametrize("kind", ["money", "heavy", "negative", "single"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(5)
    values = {
        "money": np.round(rng.lognormal(6, 2, 3000), 2),
        "heavy": np.where(rng.random(3000) < 0.4, 7.0, rng.integers(0, 10**6, 3000).astype(float)),
        "negative": rng.normal(0, 1000, 2001),
        "single": np.array([4.25]),
    }[kind]
    rows = [("a", float(v)) for v in values] + [(None, float(v)) for v in values[:7]] + [("a", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", probs).collect()}
    for key, part in (("a", values), (None, values[:7])):
        for name, p in probs.items():
            assert got[key][name] == pytest.approx(np.quantile(part, p), rel=1e-12, abs=1e-9)
    alone = exact_quantiles(df, [], "v", {"m": 0.5}).collect()
    assert alone[0].m == pytest.approx(np.quantile(np.concatenate([values, values[:7]]), 0.5))


def test_exact_quantiles_of_infinity_and_nan(spark):
    inf, nan = float("inf"), float("nan")
    data = [("a", 1.0), ("a", 3.0), ("a", inf), ("b", inf), ("b", inf), ("c", 1.0), ("c", 2.0), ("c", nan), ("d", -inf), ("d", 5.0), ("d", 7.0)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: r.m for r in exact_quantiles(df, ["k"], "v", {"m": 0.5}).collect()}
    assert got == {"a": 3.0, "b": inf, "c": 2.0, "d": 5.0}


def test_stay_quantiles_cover_the_unknown_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 4), (None, 2), (None, 3), ("b", None)], "k string, dias_perm int")
    rows = {r.k: r for r in explore.stay_quantiles(df, ["k"]).collect()}
    assert (rows["a"].median, rows[None].median, rows["b"].median) == (2.5, 2.5, None)
    assert (rows["b"].n, rows[None].max) == (1, 3)


def test_observed_expected_equals_row_sum(spark):
    rng = random.Random(1)
    rows = [(str(rng.randrange(4)), rng.choice("ABC"), rng.randrange(2)) for _ in range(500)]
    rows += [("1", None, 1)] * 5
    df = spark.createDataFrame(rows, "cnes string, cid_cap string, morte int")
    rate = {k: np.mean([r[2] for r in rows if r[1] == k]) for k in "ABC"}
    for r in explore.observed_expected(df, 1).collect():
        mine = [x for x in rows if x[0] == r.cnes and x[1]]
        assert r.n == len(mine)
        assert r.obitos_esp == pytest.approx(sum(rate[x[1]] for x in mine))


def test_weekday_distribution_keeps_absent_days(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 7),), (None,)], "d date")
    rows = explore.weekday_distribution(df, "d").collect()
    assert [(r.dow, r.n) for r in rows][0] == ("Mon", 1) and rows[6].n == 1 and rows[1].n is None


def link_tables(spark, seed, n=300):
    rng = random.Random(seed)
    day = lambda: date(2023, 12, 28) + timedelta(rng.randrange(8))
    # A third of both tables sits in one facility.
    place = lambda: "hot" if rng.random() < 0.34 else str(rng.randrange(3))
    adm = [(f"a{i:04d}", place(), day(), rng.choice([1, 3]), rng.randrange(50, 60), 1) for i in range(n)]
    dth = [(i, place(), day(), rng.choice([1, 3, None]), rng.randrange(50, 60), "1") for i in range(n)]
    return (
        adm,
        dth,
        spark.createDataFrame(adm, "id_aih string, cnes string, data date, sexo int, idade int, morte int"),
        spark.createDataFrame(dth, "id_obito long, cnes string, data date, sexo int, idade int, local_ocorrencia string"),
    )


def test_scored_linkage_matches_all_pairs(spark):
    adm, dth, a, d = link_tables(spark, 7)
    w = linkage.weights()
    expected = {}
    for i, cnes, day, sex, age, _ in dth:
        found = []
        for ia, ca, da, sa, ga, _ in adm:
            if ca != cnes or da.year != day.year:
                continue
            dd, dg = abs((da - day).days), abs(ga - age)
            score = w["data"][dd > 1] + w["idade"][dg > 1] + w["sexo"][sa != sex]
            if score >= 6.0:
                found.append((-score, dd, dg, ia))
        if found:
            best = min((round(s, 9), x, y, z) for s, x, y, z in found)
            expected[i] = (best[3], len(found))
    got = {r.id_obito: (r.id_aih, r.n_candidatos) for r in linkage.link_scored(a, d).collect()}
    assert got == expected and len(got) > 50
    mutual = linkage.mutual_best(linkage.link_scored(a, d)).collect()
    assert len({r.id_aih for r in mutual}) == len({r.id_obito for r in mutual}) == len(mutual)


def test_scored_linkage_refuses_a_loose_threshold(spark):
    _, _, a, d = link_tables(spark, 7, 5)
    with pytest.raises(ValueError):
        linkage.link_scored(a, d, threshold=1.0)


def test_exact_linkage_and_its_factored_form(spark):
    adm, dth, a, d = link_tables(spark, 9)
    pairs = {(x[0], y[0]) for x in adm for y in dth if x[1:5] == y[1:5]}
    assert {(r.id_aih, r.id_obito) for r in linkage.link_exact(a, d).collect()} == pairs
    keys = linkage.link_exact_keys(a, d)
    assert keys.agg(F.sum("n_pares")).first()[0] == len(pairs)


def test_post_discharge_matches_brute_force(spark):
    rng = random.Random(2)
    day = lambda: date(2024, 1, 1) + timedelta(rng.randrange(150))
    who = lambda: "hot" if rng.random() < 0.34 else str(rng.randrange(20))
    adm = [(i, who(), day(), rng.randrange(2)) for i in range(300)]
    dth = [(i, who(), day()) for i in range(200)]
    got = linkage.post_discharge(
        spark.createDataFrame(adm, "id long, pessoa string, dt_saida date, morte int"),
        spark.createDataFrame(dth, "id_obito long, pessoa string, dt_obito date"),
        ["pessoa"],
    ).collect()
    expected = {}
    for i, p, left, died in adm:
        later = [(d, j) for j, q, d in dth if q == p and 0 <= (d - left).days <= 30]
        if later and not died:
            expected[i] = min(later)
    assert {r.id: (r.dt_obito, r.id_obito) for r in got} == expected and expected


def test_source_keys_get_common_names(spark):
    df = spark.createDataFrame([("1", "2", "3", 4)], "CODESTAB string, CODMUNRES string, CODMUNOCOR string, x int")
    assert joins.standard_keys(df, "sim_do").columns == ["cnes", "munic_res", "munic_mov", "x"]
    assert joins.standard_keys(df.select("CODMUNRES"), "sim_do").columns == ["munic_res"]


def test_quick_profile(spark):
    df = spark.range(1000).select((c("id") % 7).alias("a"), F.lit("").alias("b"))
    rows = {r.coluna: r for r in profile.quick_profile(df).collect()}
    assert rows["a"].distintos == 7 and rows["b"].status == "100% nula" and rows["a"].total == 1000


def test_union_flagged_fills_missing_columns(spark):
    out = joins.union_flagged(
        spark.createDataFrame([(1, "x")], "id int, diag string"),
        spark.createDataFrame([(2, "b")], "id int, motivo string"),
    )
    assert {tuple(r) for r in out.select("id", "rejeitada", "diag", "motivo").collect()} == {
        (1, 0, "x", None), (2, 1, None, "b"),
    }


@pytest.mark.parametrize("n,positive", [(1000, 58), (997, 3), (20, 1), (264, 15)])
def test_split_is_exact_disjoint_and_stable(spark, n, positive):
    rows = [(i, int(i < positive)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, morte int")
    out = ml.stratified_split(df, c("id"))
    got = {r.id: r.split for r in out.collect()}
    assert len(got) == n
    size = {s: sum(1 for v in got.values() if v == s) for s in ml.SPLITS}
    other = -(-3 * n // 10)
    assert size["train"] == n - other and size["test"] == -(-other // 2)
    for label, total in ((1, positive), (0, n - positive)):
        mine = [got[i] for i, y in rows if y == label]
        assert abs(mine.count("train") - size["train"] * total / n) < 1
    again = {r.id: r.split for r in ml.stratified_split(df.repartition(7), c("id")).collect()}
    assert again == got


def test_quality_rules(spark):
    rows = [
        (1, 1, "19800101", date(2024, 1, 2), date(2024, 1, 1), 0),
        (2, 9, "00000000", date(2024, 1, 1), date(2024, 1, 2), 0),
        (3, 3, "20990101", date(2024, 1, 1), None, 1),
        (4, 3, "20300101", date(2024, 1, 1), None, 0),
    ]
    df = spark.createDataFrame(rows, "id int, sexo int, dt_nasc_raw string, dt_inter date, dt_saida date, morte int")
    kept, hits = apply_quality_rules(df, "2024-06-01")
    assert {tuple(r) for r in kept.select("id", "sexo", "dt_nasc").collect()} == {(2, None, None), (4, 3, None)}
    assert tuple(hits.first()) == (4, 1, 1, 1, 3)


def test_profile_statuses(spark):
    df = spark.createDataFrame(
        [("x", None, "a", 1), ("x", "", "b", None), ("x", None, "", None)], "k string, e string, t string, n int"
    )
    rows = {r.coluna: r for r in profile.column_profile(df).collect()}
    assert {k: r.status for k, r in rows.items()} == {
        "k": "constante", "e": "100% nula", "t": "parcialmente nula", "n": "constante",
    }
    assert rows["e"].top1 == "(vazio)" and rows["t"].nulos == 1
    assert tuple(profile.status_counts(profile.column_profile(df)).first()) == (4, 1, 2, 1)
    critical = {r.campo: r for r in profile.critical_fields(df, ["k", "zz"]).collect()}
    assert critical["k"].preenchidos == 3 and not critical["zz"].presente


def test_periods_and_plan(spark):
    base = spark.createDataFrame([("s", "RS", date(2023, 11, 1), date(2024, 2, 1))], "source string, uf string, lo date, hi date")
    months = planning.period_range(base, c("lo"), c("hi"))
    assert [(r.ano, r.mes) for r in months.collect()] == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]
    assert planning.period_range(base, c("hi"), c("lo")).count() == 0
    ledger = spark.createDataFrame([("s", "RS", "2023-12")], "source string, uf string, competencia string")
    plan = planning.incremental_plan(base, c("lo"), c("hi"), ledger)
    assert sorted(column(plan, "competencia")) == ["2023-11", "2024-01", "2024-02"]
    assert planning.incremental_plan(base, c("lo"), c("hi"), ledger, skip_completed=False).count() == 4
    today = spark.range(1).select(planning.last_period(F.lit("2024-01-31").cast("date")).alias("d"))
    assert today.first().d == date(2023, 11, 1)
    assert planning.scopes(spark, ["a", "b"], ["RS", "SC"]).count() == 4


def test_catalog_names_and_grid(spark):
    names = [
        ("sih", "RDRS2401.parquet"), ("sim", "DORS2024.parquet"), ("sinan", "DENGBR24.parquet"),
        ("sih", "RDRS2413.parquet"), ("sih", "x.csv"), ("sih", "RDRS9912.parquet"), ("sih", "ATDRS2402.PARQUET"),
    ]
    entries = planning.catalog_parse(spark.createDataFrame(names, "dataset string, file_name string"))
    got = {r.file_name: (r.tipo, r.uf, r.ano, r.mes) for r in entries.collect()}
    assert got == {
        "RDRS2401.parquet": ("RD", "RS", 2024, 1), "DORS2024.parquet": ("DO", "RS", 2024, None),
        "DENGBR24.parquet": ("DENG", "BR", 2024, None), "RDRS9912.parquet": ("RD", "RS", 1999, 12),
        "ATDRS2402.PARQUET": ("ATD", "RS", 2024, 2),
    }
    newest = {r.tipo: r.file_name for r in planning.latest_per_type(entries).collect()}
    assert newest["RD"] == "RDRS2401.parquet"
    grid = planning.availability_grid(entries, date(2024, 1, 1), date(2024, 3, 1))
    ratio = {r.tipo: (r.presentes, r.esperados) for r in planning.coverage_ratio(grid).collect()}
    assert ratio == {"RD": (1, 3), "ATD": (1, 3), "DO": (1, 1), "DENG": (1, 1)}


def test_funnel_band_is_clipped(spark):
    df = spark.createDataFrame([("a", 2, 2), ("b", 1000, 10), ("c", 500, 400)], "cnes string, n long, obitos long")
    rows = {r.cnes: r for r in indicators.funnel_outliers(df).collect()}
    assert rows["a"].limite_inf == 0.0 and rows["c"].situacao == "acima" and rows["b"].situacao == "abaixo"
