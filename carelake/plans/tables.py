"""Aggregated tables and the filtered readers over them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from carelake.operators import dashboard, gold, indicators
from carelake.operators.windows import latest_per_key
from carelake.plans.roles import adm, bed, dth, fac, money, pop, query

c = F.col

_ADM = ("cid3", "munic_res", "ano", "mes", "csap_flag", "morte", "dias_perm", "idade_anos", "val_tot", "uso_uti")


def _round(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


def cascade(t):
    return gold.care_cascade(
        t.admissions(*_ADM), t.deaths("cid3", "munic_res", "ano", "mes", "obito_hospitalar")
    )


def _cascade_of_period(t, prefix=""):
    """The cascade of the months and codes of one question, filtered before it is built."""
    deaths = t.deaths("cid3", "munic_res", "ano", "mes", "obito_hospitalar")
    return gold.care_cascade(
        *[dashboard.facts_in_period(rows, LO, HI, prefix) for rows in (t.admissions(*_ADM), deaths)]
    )


def _panel_metrics_of(t, period=True):
    """The panel without facility attributes, which the hospital readers do not use."""
    rows = t.admissions(*_PANEL_ADM)
    return gold.hospital_panel(dashboard.facts_in_period(rows, LO, HI) if period else rows)


_SIH = f"""select cid3, munic_res, ano, mes, count(*) as n, count(*) filter (csap_flag) as csap, cast(sum(morte) as bigint) as d,
    avg(dias_perm) as perm_media, avg(idade_anos) as idade_media, {money("val_tot")} as custo_total,
    {money("val_tot")} / count(val_tot) as custo_medio, cast(sum(uso_uti) as bigint) as uti
    from {adm(*_ADM)} a group by all"""
_SIM = f"""select cid3, munic_res, ano, mes, count(*) as t, cast(sum(obito_hospitalar) as bigint) as h
    from {dth("cid3", "munic_res", "ano", "mes", "obito_hospitalar")} o group by all"""
CASCADE = f"""(select cid3, munic_res, ano, mes, make_date(ano, mes, 1) as competencia,
    coalesce(n, 0) as n_internacoes, coalesce(csap, 0) as n_internacoes_csap, coalesce(d, 0) as n_mortes_hospital_sih,
    coalesce(t, 0) as n_obitos_totais, coalesce(h, 0) as n_obitos_hospitalares, perm_media, idade_media, custo_total,
    custo_medio, coalesce(uti, 0) as n_uti, case when n > 0 then cast(d as double) * 1.0 / n end as letalidade_hospitalar
    from ({_SIH}) s full join ({_SIM}) m using (cid3, munic_res, ano, mes))"""

# Both sides are checked to the sixth decimal where they average.
_CASCADE_OUT = """select cid3, munic_res, ano, mes, competencia, n_internacoes, n_internacoes_csap, n_mortes_hospital_sih,
    n_obitos_totais, n_obitos_hospitalares, round(perm_media, 6) as perm_media, round(idade_media, 6) as idade_media,
    custo_total, round(custo_medio, 6) as custo_medio, n_uti, round(letalidade_hospitalar, 6) as letalidade_hospitalar from """


@query("care_cascade", _CASCADE_OUT + CASCADE + " c")
def care_cascade(t):
    return _round(cascade(t), "perm_media", "idade_media", "custo_medio", "letalidade_hospitalar")


_PANEL_ADM = ("cnes", "cid3", "ano", "mes", "morte", "dias_perm", "uso_uti", "val_tot", "idade_anos", "csap_flag")


def panel(t):
    return gold.hospital_panel(
        t.admissions(*_PANEL_ADM),
        t.facilities("cnes", "competencia", "codufmun", "tp_unid", "esfera", "clientela"),
    )


_LATEST = f"""(select * from {fac("cnes", "competencia", "codufmun", "tp_unid", "esfera", "clientela")} f
    qualify row_number() over (partition by cnes order by competencia desc) = 1)"""
PANEL = f"""(select a.cnes, cid3, ano, mes, make_date(ano, mes, 1) as competencia, count(*) as n_internacoes,
    cast(sum(morte) as bigint) as n_mortes, avg(morte) as taxa_mortalidade, avg(dias_perm) as perm_media,
    cast(median(dias_perm) as double) as perm_mediana, cast(sum(uso_uti) as bigint) as n_uti, avg(uso_uti) as uti_pct,
    {money("val_tot")} as custo_total, {money("val_tot")} / count(val_tot) as custo_medio, avg(idade_anos) as idade_media,
    count(*) filter (csap_flag) as n_csap, any_value(codufmun) as codufmun_hosp, any_value(tp_unid) as tp_unid,
    any_value(esfera) as esfera, any_value(clientela) as clientela
    from {adm(*_PANEL_ADM)} a left join {_LATEST} l on l.cnes = a.cnes group by a.cnes, cid3, ano, mes)"""


@query(
    "hospital_panel",
    f"""select cnes, cid3, ano, mes, competencia, n_internacoes, n_mortes, round(taxa_mortalidade, 6) as taxa_mortalidade,
    round(perm_media, 6) as perm_media, perm_mediana, n_uti, round(uti_pct, 6) as uti_pct, custo_total,
    round(custo_medio, 6) as custo_medio, round(idade_media, 6) as idade_media, n_csap, codufmun_hosp, tp_unid, esfera,
    clientela from {PANEL} p""",
)
def hospital_panel(t):
    return _round(
        panel(t), "taxa_mortalidade", "perm_media", "uti_pct", "custo_medio", "idade_media"
    )


_MORT_ADM = ("munic_res", "ano", "mes", "morte", "dias_perm", "uso_uti", "val_tot")
MORTALITY = f"""(select munic_res as cod6, ano, mes, make_date(ano, mes, 1) as competencia, count(*) as internacoes,
    cast(sum(morte) as bigint) as obitos, cast(sum(morte) as double) * 100.0 / count(*) as taxa_mortalidade,
    avg(dias_perm) as permanencia_media, cast(sum(uso_uti) as bigint) as internacoes_uti, {money("val_tot")} as custo_total
    from {adm(*_MORT_ADM)} a where left(munic_res, 2) = '43' group by munic_res, ano, mes)"""


def mortality(t):
    return gold.municipality_mortality(t.admissions(*_MORT_ADM))


@query(
    "municipality_mortality",
    f"""select * replace (round(taxa_mortalidade, 6) as taxa_mortalidade, round(permanencia_media, 6) as permanencia_media)
    from {MORTALITY} m""",
)
def municipality_mortality(t):
    return _round(mortality(t), "taxa_mortalidade", "permanencia_media")


_BEDS = ("codufmun", "ano", "mes", "cnes", "qt_sus", "qt_exist", "categoria")


def capacity(t):
    return gold.bed_capacity(t.beds(*_BEDS), t.population())


_PIVOT = ", ".join(
    f"cast(sum(case when categoria = '{k}' then qt_sus else 0 end) as bigint) as leitos_{k}_sus"
    for k in gold.BED_COLUMNS
)
CAPACITY = f"""(select g.*, populacao,
    case when populacao > 0 then leitos_sus_total::double * 1000.0 / populacao end as leitos_sus_por_1000hab,
    case when populacao > 0 then leitos_uti_sus::double * 100000.0 / populacao end as leitos_uti_por_100khab
    from (select codufmun, ano, mes, make_date(ano, mes, 1) as competencia, count(distinct cnes) as n_hospitais,
      cast(sum(qt_sus) as bigint) as leitos_sus_total, cast(sum(qt_exist) as bigint) as leitos_total, {_PIVOT}
      from {bed(*_BEDS)} b group by codufmun, ano, mes) g left join {pop()} p on p.cod6 = g.codufmun)"""


@query("bed_capacity", f"select * from {CAPACITY} c")
def bed_capacity(t):
    return capacity(t)


@query(
    "stored_beds",
    f"""select codufmun as municipio, cast(ano as varchar) || lpad(cast(mes as varchar), 2, '0') as competencia, leitos_sus_total as total_leitos_sus,
    populacao as pop_estimada, round(coalesce(case when populacao > 0 then leitos_sus_total::double / populacao * 1000 end, 0.0), 4) as leitos_por_1000hab
    from {CAPACITY} c""",
)
def stored_beds(t):
    return indicators.stored_beds(capacity(t))


@query(
    "mortality_trend",
    f"""select cod6, count(*) as meses, round(regr_slope(taxa_mortalidade, ano * 12 + mes), 6) as pp_por_mes,
    round(regr_r2(taxa_mortalidade, ano * 12 + mes), 6) as r2
    from {MORTALITY} m where taxa_mortalidade is not null group by cod6 having count(*) >= 6""",
)
def mortality_trend(t):
    return _round(indicators.mortality_trend(mortality(t)), "pp_por_mes", "r2")


@query(
    "per_capita",
    f"""select m.cod6, ano, mes, internacoes, populacao,
    case when populacao > 0 then internacoes::double * 1000.0 / populacao end as internacoes_por_mil
    from {MORTALITY} m left join {pop()} p on p.cod6 = m.cod6""",
)
def per_capita(t):
    slim = mortality(t).select("cod6", "ano", "mes", "internacoes")
    return gold.per_capita(
        slim, t.population(), ["cod6"], {"internacoes_por_mil": ("internacoes", 1000)}
    )


@query(
    "stored_rate",
    f"""select cod6 as municipio, cast(ano as varchar) || lpad(cast(mes as varchar), 2, '0') as competencia,
    internacoes as total_internacoes, obitos as total_obitos, round(coalesce(taxa_mortalidade, 0.0), 4) as taxa_mortalidade
    from {MORTALITY} m""",
)
def stored_rate(t):
    from carelake.operators.indicators import stored_rate as stored

    return stored(mortality(t))


@query(
    "latest_per_key",
    f"select * from {_LATEST} l",
)
def latest(t):
    rows = t.facilities("cnes", "competencia", "codufmun", "tp_unid", "esfera", "clientela")
    return latest_per_key(rows, ["cnes"], [c("competencia").desc_nulls_last()])


# --- filtered readers --------------------------------------------------------

LO, HI = date(1996, 3, 1), date(1999, 8, 1)
_IN = f"competencia between date '{LO}' and date '{HI}'"


@query(
    "coverage_summary",
    f"""select min(competencia) as inicio, max(competencia) as fim, count(distinct cid3) as n_cids,
    cast(sum(n_internacoes) as bigint) as total_internacoes, cast(sum(n_obitos_totais) as bigint) as total_obitos,
    (select count(distinct cnes) from {PANEL} p) as n_hospitais, (select count(distinct codufmun) from {CAPACITY} b) as n_municipios,
    (select cast(sum(leitos_sus_total) as bigint) from {CAPACITY} b) as soma_leitos from {CASCADE} c""",
)
def coverage_summary(t):
    return dashboard.coverage_summary(cascade(t), panel(t), capacity(t))


_RANK_CODES = f"""select cid3, cast(sum(n_internacoes) as bigint) as internacoes, cast(sum(n_internacoes_csap) as bigint) as csap,
    cast(sum(n_mortes_hospital_sih) as bigint) as mortes_hospital_sih, cast(sum(n_obitos_totais) as bigint) as obitos_sim,
    round(case when sum(n_internacoes) > 0 then sum(n_mortes_hospital_sih)::double / sum(n_internacoes)::double end, 6) as letalidade,
    round(avg(perm_media), 6) as perm_media, {money("custo_total")} as custo_total from {CASCADE} c where {_IN}"""


@query(
    "rank_codes",
    _RANK_CODES + " group by cid3 having sum(n_internacoes) > 0 order by internacoes desc, cid3 limit 50",
)
def rank_codes(t):
    return _round(dashboard.rank_codes(_cascade_of_period(t), LO, HI, n=50), "letalidade", "perm_media")


@query(
    "period_prefix_filter",
    _RANK_CODES + " and cid3 like 'J%' group by cid3 having sum(n_internacoes) > 0 order by internacoes desc, cid3 limit 50",
)
def period_prefix_filter(t):
    return _round(dashboard.rank_codes(_cascade_of_period(t, "j"), LO, HI, "j", 50), "letalidade", "perm_media")


@query(
    "series_by_period",
    f"""select competencia, cast(sum(n_internacoes) as bigint) as internacoes, cast(sum(n_obitos_totais) as bigint) as obitos,
    cast(sum(n_internacoes_csap) as bigint) as csap, {money("custo_total")} as custo from {CASCADE} c
    where {_IN} and cid3 like 'I%' group by competencia order by competencia""",
)
def series_by_period(t):
    return dashboard.series_by_period(_cascade_of_period(t, "I"), LO, HI, "I")


_PANEL_METRICS = f"""cast(sum(n_internacoes) as bigint) as internacoes, cast(sum(n_mortes) as bigint) as mortes,
    round(case when sum(n_internacoes) > 0 then sum(n_mortes)::double / sum(n_internacoes)::double end, 6) as mortalidade,
    round(avg(perm_media), 6) as perm_media, round(avg(uti_pct), 6) as uti_pct, {money("custo_total")} as custo_total,
    round(avg(custo_medio), 7) as custo_medio"""


def _panel_round(df):
    return _round(_round(df, "mortalidade", "perm_media", "uti_pct"), "custo_medio", digits=7)


@query(
    "rank_hospitals",
    f"""select cnes, {_PANEL_METRICS} from {PANEL} p where {_IN} group by cnes having sum(n_internacoes) >= 10
    order by internacoes desc, cnes limit 30""",
)
def rank_hospitals(t):
    return _panel_round(dashboard.rank_hospitals(_panel_metrics_of(t), LO, HI, n=30))


@query(
    "hospital_profile",
    f"""select cid3, {_PANEL_METRICS}, round(avg(idade_media), 6) as idade_media, cast(sum(n_csap) as bigint) as csap
    from {PANEL} p where cnes = '0000007' and {_IN} group by cid3 having sum(n_internacoes) >= 5
    order by internacoes desc, cid3 limit 30""",
)
def hospital_profile(t):
    return _round(
        _panel_round(dashboard.hospital_profile(_panel_metrics_of(t), "0000007", LO, HI, 30)), "idade_media"
    )


@query(
    "mean_capacity",
    f"""select codufmun, {", ".join(f"round(avg({s}), 6) as {d}" for s, d in dashboard._CAPACITY_MEANS.items())}
    from {CAPACITY} c where {_IN} group by codufmun having avg(leitos_sus_total) > 0
    order by avg(leitos_sus_total) desc, codufmun limit 50""",
)
def mean_capacity(t):
    return _round(
        dashboard.mean_capacity(capacity(t), LO, HI, 50), *dashboard._CAPACITY_MEANS.values()
    )


@query(
    "pick_lists",
    f"""(select 'cid3' as lista, cid3 as valor, n from (select cid3, cast(sum(n_internacoes) as bigint) as n from {CASCADE} c
      group by cid3 order by n desc, cid3 limit 200) x where cid3 is not null)
    union all (select 'cnes', cnes, n from (select cnes, cast(sum(n_internacoes) as bigint) as n from {PANEL} p
      group by cnes having sum(n_internacoes) >= 10 order by n desc, cnes limit 500) y where cnes is not null)""",
)
def pick_lists(t):
    codes = dashboard.pick_lists(cascade(t), "cid3", 200)
    hospitals = dashboard.pick_lists(_panel_metrics_of(t, period=False), "cnes", 500, 10)
    return codes.select(F.lit("cid3").alias("lista"), c("cid3").alias("valor"), "n").unionByName(
        hospitals.select(F.lit("cnes").alias("lista"), c("cnes").alias("valor"), "n")
    )
