"""Rates, flows, checks and column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake import functions as cf
from carelake.functions.codes import URGENT_CODES
from carelake.operators import explore, profile, sketches
from carelake.plans.roles import _SHIP, RAW_ADMISSION, adm, money, query, role_sql
from carelake.plans.scalars import sql_ymd
from carelake.plans.tables import _round
from carelake.schemas import CATEGORY_LABELS, CRITICAL_COLUMNS, DATE_COLUMNS, HIGH_CARDINALITY_COLUMNS, NUMERIC_COLUMNS
from carelake.session import shared_path

c = F.col

_RATE = """count(*) as n, cast(sum(morte) as bigint) as obitos, sum(morte)::double * 100.0 / count(*) as tx_mort_pct"""


@query("volume_by_period", f"select ano, mes, count(*) as n from {adm('ano', 'mes')} a group by all")
def volume_by_period(t):
    return explore.volume_by_period(t.admissions("ano", "mes"))


@query(
    "overview",
    f"""select count(distinct munic_res) as munic_res, count(distinct munic_mov) as munic_atend,
    count(distinct cnes) as hospitais, cast(sum(morte) as bigint) as obitos_totais,
    sum(morte)::double * 100.0 / count(*) as tx_mort_pct_geral from {adm("munic_res", "munic_mov", "cnes", "morte")} a""",
)
def overview(t):
    return explore.overview(t.admissions("munic_res", "munic_mov", "cnes", "morte"))


@query(
    "rate_by_group",
    " union all ".join(
        f"select '{k}' as grupo, cast({e} as varchar) as valor, {_RATE} from {adm(*used, 'morte')} a group by {e}"
        for k, e, used in (
            *((k, k, (k,)) for k in ("sexo", "faixa_etaria", "cid_cap", "munic_mov", "cid_principal")),
            ("dia_semana", "dayofweek(dt_inter)", ("dt_inter",)),
            ("transferido", "munic_res <> munic_mov", ("munic_res", "munic_mov")),
        )
    ),
)
def rate_by_group(t):
    few = ["sexo", "faixa_etaria", "cid_cap", "dia_semana", "transferido"]
    rows = t.admissions("sexo", "faixa_etaria", "cid_cap", "munic_mov", "munic_res", "cid_principal", "dt_inter", "morte")
    rows = explore.transferred(rows).withColumn("dia_semana", cf.dow_sunday0(c("dt_inter")))
    out = explore.rate_by_each(rows, few)
    for k in ("munic_mov", "cid_principal"):  # many values: a table of its own
        per_value = explore.rate_by(rows, k).withColumn("grupo", F.lit(k)).withColumn("valor", c(k).cast("string"))
        out = out.unionByName(per_value.drop(k))
    return out


@query(
    "care_places",
    f"""select munic_mov, {_RATE}, count(distinct cnes) as hospitais from {adm("munic_mov", "cnes", "morte")} a
    group by munic_mov order by n desc, munic_mov limit 15""",
)
def care_places(t):
    return explore.care_places(t.admissions("munic_mov", "cnes", "morte"))


@query(
    "rate_extremes",
    f"""with r as (select munic_mov, {_RATE} from {adm("munic_mov", "morte")} a group by munic_mov having count(*) >= 500)
    (select 'maior' as lado, * from r order by tx_mort_pct desc, munic_mov limit 10)
    union all (select 'menor', * from r order by tx_mort_pct, munic_mov limit 10)""",
)
def rate_extremes(t):
    rows = t.admissions("munic_mov", "morte")
    side = lambda high, name: explore.rate_extremes(
        rows, "munic_mov", 500, 10, high
    ).select(F.lit(name).alias("lado"), "*")
    return side(True, "maior").unionByName(side(False, "menor"))


@query(
    "stay_quantiles",
    f"""select sexo, count(*) as n, min(dias_perm) as min, max(dias_perm) as max, round(avg(dias_perm), 6) as mean,
    round(quantile_cont(dias_perm, 0.25), 6) as p25, round(quantile_cont(dias_perm, 0.5), 6) as median,
    round(quantile_cont(dias_perm, 0.75), 6) as p75, round(quantile_cont(dias_perm, 0.95), 6) as p95
    from {adm("sexo", "dias_perm")} a group by sexo""",
)
def stay_quantiles(t):
    out = explore.stay_quantiles(t.admissions("sexo", "dias_perm"), ["sexo"])
    return _round(out, "mean", "p25", "median", "p75", "p95")


@query(
    "flow_destinations",
    f"""select munic_mov, count(*) as recebidos, count(distinct munic_res) as munic_origem,
    sum(morte)::double * 100.0 / count(*) as tx_mort_transf from {adm("munic_res", "munic_mov", "morte")} a
    where munic_res <> munic_mov group by munic_mov order by recebidos desc, munic_mov limit 10""",
)
def flow_destinations(t):
    return explore.flow_destinations(t.admissions("munic_res", "munic_mov", "morte"))


@query(
    "flow_origins",
    f"""select munic_res, count(*) as exportados, count(distinct munic_mov) as destinos
    from {adm("munic_res", "munic_mov")} a where munic_res <> munic_mov
    group by munic_res order by exportados desc, munic_res limit 10""",
)
def flow_origins(t):
    return explore.flow_origins(t.admissions("munic_res", "munic_mov", "morte"))


_URGENT = ", ".join(f"'{x}'" for x in URGENT_CODES)


@query(
    "urgent_transfer",
    f"""select cid_principal, munic_res <> munic_mov as transferido, {_RATE}
    from {adm("cid_principal", "munic_res", "munic_mov", "morte")} a where cid_principal in ({_URGENT}) group by 1, 2""",
)
def urgent_transfer(t):
    return explore.urgent_transfer(
        t.admissions("cid_principal", "munic_res", "munic_mov", "morte")
    )


OBSERVED = f"""with a as (select * from {adm("cnes", "cid_cap", "morte")} r where cid_cap is not null),
    e as (select cid_cap, sum(morte)::double / count(*) as rate from a group by cid_cap)
    select cnes, count(*) as n, cast(sum(morte) as bigint) as obitos_obs, round(sum(rate), 6) as obitos_esp,
    round(sum(morte)::double / count(*) * 100, 6) as tx_obs_pct, round(sum(rate) / count(*) * 100, 6) as tx_esp_pct,
    round(sum(morte)::double / count(*) * 100 - sum(rate) / count(*) * 100, 6) as excesso_pp
    from a join e using (cid_cap) group by cnes having count(*) >= 500"""


@query(
    "observed_expected",
    OBSERVED,
)
def observed_expected(t):
    out = explore.observed_expected(t.admissions("cnes", "cid_cap", "morte"), 500)
    return _round(out, "obitos_esp", "tx_obs_pct", "tx_esp_pct", "excesso_pp")


@query(
    "excess_extremes",
    f"""with t as ({OBSERVED}) (select 'pior' as lado, * from t order by excesso_pp desc, cnes limit 10)
    union all (select 'melhor', * from t order by excesso_pp, cnes limit 10)""",
)
def excess_extremes(t):
    """The ten hospitals furthest above and below what their mix of cases lets expect."""
    table = observed_expected(t)
    side = lambda worst, name: explore.excess_extremes(table, 10, worst).select(F.lit(name).alias("lado"), "*")
    return side(True, "pior").unionByName(side(False, "melhor"))


@query(
    "silence_proxy",
    f"""select munic_res, count(*) as internacoes_residentes, count(*) filter (munic_res <> munic_mov) as exportados,
    cast(sum(morte) as bigint) as obitos, sum(morte)::double * 100.0 / count(*) as tx_mort_pct,
    count(*) filter (munic_res <> munic_mov)::double * 100.0 / count(*) as pct_exportado
    from {adm("munic_res", "munic_mov", "morte")} a group by munic_res
    having internacoes_residentes >= 1000 and pct_exportado > 60 and tx_mort_pct > 5.6
    order by tx_mort_pct desc, munic_res limit 15""",
)
def silence_proxy(t):
    return explore.silence_proxy(
        t.admissions("munic_res", "munic_mov", "morte"), min_export_pct=60
    )


@query(
    "synthesis",
    f"""select count(*) as internacoes, cast(sum(morte) as bigint) as obitos, count(distinct munic_res) as munic_res,
    count(distinct munic_mov) as munic_atend, count(distinct cnes) as hospitais, count(distinct cid_principal) as cids,
    min(dt_inter) as primeira_internacao, max(dt_inter) as ultima_internacao
    from {adm("munic_res", "munic_mov", "cnes", "cid_principal", "morte", "dt_inter")} a""",
)
def synthesis(t):
    return explore.synthesis(
        t.admissions("munic_res", "munic_mov", "cnes", "cid_principal", "morte", "dt_inter")
    )


@query(
    "age_sanity",
    f"""select min(idade) as min_idade, max(idade) as max_idade, count(*) filter (idade < 0) as idade_negativa,
    count(*) filter (idade > 110) as idade_maior_110 from (select cast(trunc(date_diff('day', {sql_ymd("NASC")},
    {sql_ymd("DT_INTER")}) / 365.25) as int) as idade from {role_sql("raw_admission", "NASC", "DT_INTER")} r) x""",
)
def age_sanity(t):
    from carelake import functions as cf

    rows = t.role("raw_admission", "NASC", "DT_INTER")
    return explore.age_sanity(
        rows.select(
            cf.age_from_dates(cf.parse_ymd(c("NASC")), cf.parse_ymd(c("DT_INTER"))).alias("idade")
        )
    )


@query(
    "calendar_distribution",
    f"""with a as (select dt_inter from {adm("dt_inter")} r where dt_inter is not null)
    select 'dow' as eixo, cast(isodow(dt_inter) as int) as ordem, strftime(dt_inter, '%a') as rotulo, count(*) as n,
      count(*)::double * 100.0 / (select count(*) from a) as pct from a group by 2, 3
    union all select 'dom', cast(dayofmonth(dt_inter) as int), cast(dayofmonth(dt_inter) as varchar), count(*),
      count(*)::double * 100.0 / (select count(*) from a) from a group by 2, 3""",
)
def calendar_distribution(t):
    rows = t.admissions("dt_inter")
    week = explore.weekday_distribution(rows, "dt_inter").select(
        F.lit("dow").alias("eixo"), "ordem", c("dow").alias("rotulo"), "n", "pct"
    )
    month = explore.month_day_distribution(rows, "dt_inter").select(
        F.lit("dom").alias("eixo"), c("dom").alias("ordem"), c("dom").cast("string").alias("rotulo"), "n", "pct"
    )
    return week.unionByName(month)


# --- profiles ---------------------------------------------------------------

_RAW_COLUMNS = tuple(RAW_ADMISSION)
_RAW = role_sql("raw_admission", *_RAW_COLUMNS)
_LONG = " union all ".join(
    f"select '{k}' as coluna, nullif(cast({k} as varchar), '') as valor from raw" for k in _RAW_COLUMNS
)
_VALUES = f"""raw as materialized (select * from {_RAW} r), long as ({_LONG}),
    vals as (select coluna, valor, count(*) as n from long group by all)"""


def _raw(t):
    return t.role("raw_admission", *_RAW_COLUMNS)


@query(
    "completeness",
    f"""with {_VALUES} select coluna, coalesce(cast(sum(n) filter (valor is null) as bigint), 0) as nulos,
    coalesce(sum(n) filter (valor is null), 0)::double * 100.0 / sum(n) as pct, count(*) as distintos
    from vals group by coluna""",
)
def completeness(t):
    rows = _raw(t)
    distinct = profile.cardinality(profile.value_table(rows, list(_RAW_COLUMNS)))
    return profile.completeness(rows).join(distinct, "coluna")


@query(
    "column_profile",
    f"""with {_VALUES}, r as (select *, row_number() over (partition by coluna order by n desc, valor nulls last) as p from vals)
    select coluna, cast(sum(n) as bigint) as total, coalesce(cast(sum(n) filter (valor is null) as bigint), 0) as nulos,
    count(valor) as distintos, {", ".join(f"max(case when p = {i} then coalesce(valor, '(vazio)') end) as top{i}" for i in (1, 2, 3))},
    {", ".join(f"max(case when p = {i} then n end) as n_top{i}" for i in (1, 2, 3))},
    case when coalesce(sum(n) filter (valor is null), 0) = sum(n) then '100% nula' when count(valor) = 1 then 'constante'
      when coalesce(sum(n) filter (valor is null), 0) * 2 > sum(n) then 'maioria nula'
      when coalesce(sum(n) filter (valor is null), 0) > 0 then 'parcialmente nula' else '100% preenchida' end as status
    from r group by coluna""",
)
def column_profile(t):
    return profile.column_profile(_raw(t))


_COUNTED = ("N_AIH", "CNES", "DIAG_PRINC", "SEXO", "CEP", "VAL_TOT", "PROC_REA", "ETNIA", "MARCA_UTI", "DT_INTER")
_PERIOD = ((1996, 11), (1999, 2))
_MONTHS = f"year({_SHIP}) * 12 + month({_SHIP}) between {_PERIOD[0][0] * 12 + _PERIOD[0][1]} and {_PERIOD[1][0] * 12 + _PERIOD[1][1]}"


def _sketches(t):
    """Sketches of every month, those of the period's first year written twice."""
    rows = t("lineitem").selectExpr(
        *[f"{RAW_ADMISSION[k]} as {k}" for k in _COUNTED], f"cast(year({_SHIP}) as int) as ano", f"cast(month({_SHIP}) as int) as mes"
    )
    path = shared_path(t.spark, "sketches")
    sketches.write_sketches(rows, list(_COUNTED), path)
    sketches.write_sketches(rows.where(c("ano") == _PERIOD[0][0]), list(_COUNTED), path)
    return sketches.read_sketches(t.spark, path)


@query(
    "distinct_in_period",
    " union all ".join(
        f"""select '{k}' as coluna, count(*) as linhas, count(*) - count(nullif({k}, '')) as nulos,
        case when count(distinct nullif({k}, '')) < 4096 then count(distinct nullif({k}, '')) end as distintos, true as dentro
        from (select {RAW_ADMISSION[k]} as {k} from lineitem where {_MONTHS}) x"""
        for k in _COUNTED
    ),
)
def distinct_in_period(t):
    """Distinct values of a period from stored month sketches, exact where few; beside each
    whether the bounds hold the count that the rows themselves give."""
    found = sketches.distinct_in_period(_sketches(t), *_PERIOD)
    rows = t("lineitem").where(_MONTHS).selectExpr(*[f"nullif({RAW_ADMISSION[k]}, '') as {k}" for k in _COUNTED])
    counted = profile.cardinality(profile.value_table(rows, list(_COUNTED)).where("valor is not null"))
    return found.join(counted.withColumnRenamed("distintos", "contados"), "coluna").select(
        "coluna", "linhas", "nulos", F.when(c("exato"), c("distintos")).alias("distintos"),
        c("contados").between(c("menor"), c("maior")).alias("dentro"),
    )


@query(
    "frequent_values",
    f"""with {_VALUES}, r as (select *, sum(n) over (partition by coluna) as total from vals)
    select coluna, valor, n, n::double * 100.0 / total as pct from r where n >= total * 0.01""",
)
def frequent_values(t):
    return profile.frequent_values(_raw(t), list(_RAW_COLUMNS))


@query(
    "column_status",
    f"""with {_VALUES}, s as (select coluna, cast(sum(n) as bigint) as t, coalesce(cast(sum(n) filter (valor is null) as bigint), 0) as z, count(valor) as d
      from vals group by coluna)
    select coluna, t as total, z as nulos, cast(least(d, 2) as int) as distintos,
    case when z = t then '100% nula' when d = 1 then 'constante' when z * 2 > t then 'maioria nula'
      when z > 0 then 'parcialmente nula' else '100% preenchida' end as status from s""",
)
def column_status(t):
    return profile.column_status(_raw(t))


@query(
    "status_counts",
    f"""with {_VALUES}, s as (select coluna, sum(n) as t, coalesce(sum(n) filter (valor is null), 0) as z, count(valor) as d
      from vals group by coluna)
    select count(*) as n_colunas, count(*) filter (z = t) as n_100_nulas, count(*) filter (d = 1 and z < t) as n_constantes,
    count(*) filter (z < t and d <> 1) as n_uteis from s""",
)
def status_counts(t):
    return profile.status_counts(profile.column_status(_raw(t)))


_CATEGORIES = tuple(k for k in CATEGORY_LABELS if k in RAW_ADMISSION)
_LABELLED = {k: CATEGORY_LABELS[k] for k in _CATEGORIES if CATEGORY_LABELS[k]}
_LABEL_SQL = "coalesce(case coluna || ':' || valor {} end, '')".format(
    " ".join(f"when '{k}:{v}' then '{label}'" for k, m in _LABELLED.items() for v, label in m.items())
)


@query(
    "value_counts",
    f"""with {_VALUES}, r as (select *, row_number() over (partition by coluna order by n desc, valor nulls last) as posicao,
      sum(n) over (partition by coluna) as total from vals where coluna in {_CATEGORIES})
    select coluna, cast(posicao as int) as posicao, coalesce(valor, '(vazio)') as valor, n, n::double * 100.0 / total as pct,
    {_LABEL_SQL} as rotulo from r where posicao <= 10""",
)
def value_counts(t):
    return profile.value_counts(_raw(t), list(_CATEGORIES), 10, _LABELLED)


_CODES = HIGH_CARDINALITY_COLUMNS


@query(
    "high_cardinality",
    f"""with raw as materialized (select * from {role_sql("raw_admission", *_CODES)} r),
    vals as (select coluna, valor, count(*) as n from ({" union all ".join(f"select '{k}' as coluna, {k} as valor from raw" for k in _CODES)}) l group by all)
    select coluna, valor, n, cast(row_number() over (partition by coluna order by n desc, valor nulls last) as int) as posicao,
    count(*) over (partition by coluna) as distintos from vals qualify posicao <= 10""",
)
def high_cardinality(t):
    return profile.high_cardinality(t.role("raw_admission", *_CODES), list(_CODES))


_NUMERIC = tuple(k for k in NUMERIC_COLUMNS if k in RAW_ADMISSION)


@query(
    "numeric_summary",
    " union all ".join(
        f"""select '{k}' as coluna, count({k}) as n_naonulos, count(*) filter ({k} = 0) as n_zeros, min({k}) + 0.0 as min,
        max({k}) as max, round(avg({k}), 6) as media, round(stddev_samp({k}), 6) as std,
        round(quantile_cont({k}, 0.25), 6) as p25, round(quantile_cont({k}, 0.5), 6) as p50,
        round(quantile_cont({k}, 0.75), 6) as p75, round(quantile_cont({k}, 0.95), 6) as p95
        from (select try_cast(trim({k}) as double) as {k} from {role_sql("raw_admission", k)} r) x"""
        for k in _NUMERIC
    ),
)
def numeric_summary(t):
    out = profile.numeric_summary(t.role("raw_admission", *_NUMERIC), list(_NUMERIC))
    return _round(out, "media", "std", "p25", "p50", "p75", "p95").withColumn(
        "min", c("min") + 0.0
    )


@query(
    "date_validity",
    " union all ".join(
        f"""select '{k}' as coluna, count(d) as validas, count(*) - count(d) as invalidas,
        (count(*) - count(d))::double * 100.0 / count(*) as pct_invalidas, min(d) as min, max(d) as max
        from (select {sql_ymd(k)} as d from {role_sql("raw_admission", k)} r) x"""
        for k in DATE_COLUMNS
    ),
)
def date_validity(t):
    return profile.date_validity(t.role("raw_admission", *DATE_COLUMNS), list(DATE_COLUMNS))


_HAVE = [k for k in CRITICAL_COLUMNS if k != "UF_ZI"]


@query(
    "critical_fields",
    f"with raw as materialized (select * from {role_sql('raw_admission', *_HAVE)} r) "
    + " union all ".join(
        f"""select '{k}' as campo, true as presente, count(nullif({k}, '')) as preenchidos,
        count(nullif({k}, ''))::double * 100.0 / count(*) as pct from raw"""
        for k in _HAVE
    )
    + " union all select 'UF_ZI', false, null, null",
)
def critical_fields(t):
    return profile.critical_fields(t.role("raw_admission", *_HAVE), list(CRITICAL_COLUMNS))


# A twelfth of the rows carries a part that does not add up.
_PARTS = """l_extendedprice as val_tot, l_extendedprice - l_quantity as val_sh,
    case when l_partkey % 12 = 0 then l_quantity + 0.01 else l_quantity end as val_sp"""
_DEC = "cast({} as decimal(18,2))".format


@query(
    "total_mismatch",
    f"""select count(*) as linhas, count(*) filter (d <> 0) as divergentes, count(*) filter (d <> 0)::double * 100.0 / count(*) as pct_divergente,
    cast(sum(abs(d)) as double) as soma_diferenca from
    (select {_DEC("val_tot")} - {_DEC("val_sh")} - {_DEC("val_sp")} as d from (select {_PARTS} from lineitem) x) y""",
)
def total_mismatch(t):
    rows = t("lineitem").selectExpr(*[p for p in _PARTS.replace("\n", " ").split(", ")])
    return profile.total_mismatch(rows, "val_tot", ["val_sh", "val_sp"])
