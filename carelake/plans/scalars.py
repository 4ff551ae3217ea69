"""Scalar derivations over every row of a driver table."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake import functions as cf
from carelake.functions.codes import CHAPTER_NAMES, OUTCOME_CLASSES, SENSITIVE_REGEX
from carelake.operators.clean import (
    apply_quality_rules,
    clean_admissions,
    clean_beds,
    clean_deaths,
    clean_facilities,
)
from carelake.plans.roles import adm, dmy, query, role_sql, ymd
from carelake.schemas import FACILITY_RENAMES, RAW_FACILITIES

c = F.col

# --- check-engine spellings of the same rules -------------------------------


def sql_int(x: str) -> str:
    return f"try_cast({x} as integer)"


def sql_ymd(x: str) -> str:
    return f"case when regexp_full_match({x}, '[0-9]{{8}}') then cast(try_strptime({x}, '%Y%m%d') as date) end"


def sql_dmy(x: str) -> str:
    return f"case when regexp_full_match({x}, '[0-9]{{8}}') then cast(try_strptime({x}, '%d%m%Y') as date) end"


def sql_band(age: str) -> str:
    return (
        f"case when {age} < 1 then '<1' when {age} < 15 then '1-14' when {age} < 30 then '15-29' "
        f"when {age} < 45 then '30-44' when {age} < 60 then '45-59' when {age} < 75 then '60-74' "
        "else '75+' end"
    )


def sql_admission_age(value: str, unit: str) -> str:
    return f"case {unit} when '4' then {sql_int(value)} when '5' then {sql_int(value)} + 100 else 0 end"


def sql_packed_age(x: str) -> str:
    return (
        f"case when {x} is null or length({x}) < 2 then null when {x}[1] = '4' "
        f"then {sql_int(f'substr({x}, 2)')} when {x}[1] = '5' then {sql_int(f'substr({x}, 2)')} + 100 else 0 end"
    )


def sql_period(y: str, m: str) -> str:
    return f"case when {m} between 1 and 12 then make_date({y}, {m}, 1) end"


def sql_map(key: str, mapping: dict) -> str:
    arms = " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items())
    return f"case {key} {arms} end"


RAW = f"{role_sql('raw_admission')} r"
RAW_DEATH = f"{role_sql('raw_death')} r"


# Numeric text in the shapes the files hold: plain, blank-padded, fractional, exponent, empty.
_NUMBER = (
    "case o_orderkey % 7 when 0 then '12.5' when 1 then ' 7 ' when 2 then '' when 3 then '4e2' "
    "when 4 then 'abc' when 5 then cast(o_totalprice as string) else cast(o_orderkey as string) end"
)


@query(
    "safe_cast",
    f"""select o_orderkey, try_cast(t as integer) as as_int, try_cast(t as bigint) as as_long,
        try_cast(t as double) as as_double from (select o_orderkey, {_NUMBER} as t from orders) x""",
)
def safe_cast(t):
    text = t("orders").selectExpr("o_orderkey", f"{_NUMBER} as t")
    return text.select(
        "o_orderkey",
        cf.to_int(c("t")).alias("as_int"),
        cf.to_long(c("t")).alias("as_long"),
        cf.to_double(c("t")).alias("as_double"),
    )


_MONTH = "case when o_orderkey % 9 = 0 then '13' when o_orderkey % 10 = 0 then null else cast(month(o_orderdate) as string) end"


@query(
    "period_date",
    f"""select o_orderkey, {sql_period("y", "m")} as competencia from (select o_orderkey,
        cast(year(o_orderdate) as int) as y, try_cast({_MONTH} as int) as m from orders) x""",
)
def period_date(t):
    raw = t("orders").selectExpr("o_orderkey", "year(o_orderdate) as y", f"{_MONTH} as m")
    return raw.select("o_orderkey", cf.period_date(c("y"), cf.to_int(c("m"))).alias("competencia"))


@query(
    "period_split",
    f"""select CNES as cnes, COMPETEN as competen, try_cast(substr(COMPETEN, 1, 4) as int) as ano,
        try_cast(substr(COMPETEN, 5, 2) as int) as mes from {role_sql("raw_bed")} b""",
)
def period_split(t):
    raw = t.role("raw_bed", "CNES", "COMPETEN")
    return raw.select(
        c("CNES").alias("cnes"),
        c("COMPETEN").alias("competen"),
        cf.period_year(c("COMPETEN")).alias("ano"),
        cf.period_month(c("COMPETEN")).alias("mes"),
    )


@query(
    "parse_ymd",
    f"select DT_INTER as texto, {sql_ymd('DT_INTER')} as dt_inter, {sql_ymd('DT_SAIDA')} as dt_saida from {RAW}",
)
def parse_ymd(t):
    return t.role("raw_admission", "DT_INTER", "DT_SAIDA").select(
        c("DT_INTER").alias("texto"),
        cf.parse_ymd(c("DT_INTER")).alias("dt_inter"),
        cf.parse_ymd(c("DT_SAIDA")).alias("dt_saida"),
    )


@query(
    "parse_dmy",
    f"""select CONTADOR as contador, d as dt_obito, cast(year(d) as int) as ano,
        cast(month(d) as int) as mes, {sql_dmy("DTNASC")} as dt_nasc
        from (select *, {sql_dmy("DTOBITO")} as d from {RAW_DEATH}) x""",
)
def parse_dmy(t):
    day = cf.parse_dmy(c("DTOBITO"))
    return t.role("raw_death", "CONTADOR", "DTOBITO", "DTNASC").select(
        c("CONTADOR").alias("contador"),
        day.alias("dt_obito"),
        F.year(day).alias("ano"),
        F.month(day).alias("mes"),
        cf.parse_dmy(c("DTNASC")).alias("dt_nasc"),
    )


@query(
    "code_group",
    f"""select N_AIH as n_aih, DIAG_PRINC as codigo,
        case when length(DIAG_PRINC) >= 3 then left(DIAG_PRINC, 3) end as cid3 from {RAW}""",
)
def code_group(t):
    return t.role("raw_admission", "N_AIH", "DIAG_PRINC").select(
        c("N_AIH").alias("n_aih"),
        c("DIAG_PRINC").alias("codigo"),
        cf.code_group(c("DIAG_PRINC")).alias("cid3"),
    )


@query(
    "code_chapter",
    f"select CONTADOR as contador, left(CAUSABAS, 1) as capitulo_cid from {RAW_DEATH}",
)
def code_chapter(t):
    return t.role("raw_death", "CONTADOR", "CAUSABAS").select(
        c("CONTADOR").alias("contador"), cf.code_chapter(c("CAUSABAS")).alias("capitulo_cid")
    )


@query(
    "code_label",
    f"""select N_AIH as n_aih, coalesce({sql_map("left(DIAG_PRINC, 1)", CHAPTER_NAMES)}, '?') as capitulo
        from {RAW}""",
)
def code_label(t):
    return t.role("raw_admission", "N_AIH", "DIAG_PRINC").select(
        c("N_AIH").alias("n_aih"),
        cf.chapter_label(cf.code_chapter(c("DIAG_PRINC"))).alias("capitulo"),
    )


@query(
    "prefix_flag",
    f"""select N_AIH as n_aih, DIAG_PRINC as codigo,
        regexp_matches(DIAG_PRINC, '{SENSITIVE_REGEX}') as csap_flag from {RAW}""",
)
def prefix_flag(t):
    return t.role("raw_admission", "N_AIH", "DIAG_PRINC").select(
        c("N_AIH").alias("n_aih"),
        c("DIAG_PRINC").alias("codigo"),
        cf.is_sensitive(c("DIAG_PRINC")).alias("csap_flag"),
    )


@query(
    "age_decode_unit",
    f"""select N_AIH as n_aih, IDADE as valor, COD_IDADE as unidade,
        {sql_admission_age("IDADE", "COD_IDADE")} as idade_anos from {RAW}""",
)
def age_decode_unit(t):
    return t.role("raw_admission", "N_AIH", "IDADE", "COD_IDADE").select(
        c("N_AIH").alias("n_aih"),
        c("IDADE").alias("valor"),
        c("COD_IDADE").alias("unidade"),
        cf.decode_admission_age(c("IDADE"), c("COD_IDADE")).alias("idade_anos"),
    )


@query(
    "age_decode_packed",
    f"""select CONTADOR as contador, IDADE as valor, {sql_packed_age("IDADE")} as idade_anos,
        coalesce(IDADE in ({", ".join(f"'{n}'" for n in range(400, 412))}), false) as ambigua from {RAW_DEATH}""",
)
def age_decode_packed(t):
    # Three-digit 400-411 may be months or years; such rows are marked.
    ambiguous = F.coalesce(c("IDADE").rlike("^4(0[0-9]|1[01])$"), F.lit(False))
    return t.role("raw_death", "CONTADOR", "IDADE").select(
        c("CONTADOR").alias("contador"),
        c("IDADE").alias("valor"),
        cf.decode_packed_age(c("IDADE")).alias("idade_anos"),
        ambiguous.alias("ambigua"),
    )


@query(
    "age_band",
    f"select id_aih, idade_anos, {sql_band('idade_anos')} as faixa_etaria from {adm('id_aih', 'idade_anos')} a",
)
def age_band(t):
    return t.admissions("id_aih", "idade_anos").withColumn(
        "faixa_etaria", cf.age_band(c("idade_anos"))
    )


@query(
    "age_band8",
    f"""select id_aih, case when a < 1 then '0 <1ano' when a < 15 then '1 1-14' when a < 30 then '2 15-29'
        when a < 45 then '3 30-44' when a < 60 then '4 45-59' when a < 75 then '5 60-74'
        when a < 90 then '6 75-89' else '7 90+' end as faixa
        from (select id_aih, idade_anos as a from {adm("id_aih", "idade_anos")} r) x""",
)
def age_band8(t):
    return t.admissions("id_aih", "idade_anos").select(
        "id_aih", cf.age_band8(c("idade_anos")).alias("faixa")
    )


@query(
    "age_from_dates",
    f"""select N_AIH as n_aih, cast(trunc(date_diff('day', b, d) / 365.25) as int) as idade
        from (select N_AIH, {sql_ymd("NASC")} as b, {sql_ymd("DT_INTER")} as d from {RAW}) x""",
)
def age_from_dates(t):
    return t.role("raw_admission", "N_AIH", "NASC", "DT_INTER").select(
        c("N_AIH").alias("n_aih"),
        cf.age_from_dates(cf.parse_ymd(c("NASC")), cf.parse_ymd(c("DT_INTER"))).alias("idade"),
    )


@query(
    "cause_flags",
    f"""select CONTADOR as contador,
        cast(coalesce(left(CAUSABAS, 1) in ('V', 'W', 'X', 'Y'), false) as int) as causa_externa,
        cast(coalesce(left(CAUSABAS, 1) = 'O', false) as int) as causa_materna,
        cast(coalesce(TIPOBITO = '1', false) as int) as obito_fetal,
        cast(coalesce(LOCOCOR = '1', false) as int) as obito_hospitalar from {RAW_DEATH}""",
)
def cause_flags(t):
    return clean_deaths(t.role("raw_death").withColumn("DTOBITO", F.lit("01012024"))).select(
        c("contador").cast("string").alias("contador"),
        "causa_externa",
        "causa_materna",
        "obito_fetal",
        "obito_hospitalar",
    )


_BED_SQL = (
    "case when try_cast(CODLEITO as int) between 51 and 78 then 'uti' else coalesce("
    + sql_map(
        "TP_LEITO",
        {"1": "cirurgico", "2": "clinico", "4": "obstetrico", "5": "pediatrico", "7": "hospital_dia"},
    )
    + ", 'outros') end"
)


@query(
    "bed_category",
    f"select CODLEITO as codleito, TP_LEITO as tp_leito, {_BED_SQL} as categoria from {role_sql('raw_bed')} b",
)
def bed_category(t):
    return t.role("raw_bed", "CODLEITO", "TP_LEITO").select(
        c("CODLEITO").alias("codleito"),
        c("TP_LEITO").alias("tp_leito"),
        cf.bed_category(c("CODLEITO"), c("TP_LEITO")).alias("categoria"),
    )


@query(
    "composite_key",
    f"""select CNES || '|' || substr(COMPETEN, 1, 4) || '-' || substr(COMPETEN, 5, 2) as cnes_competen
        from {role_sql("raw_bed")} b""",
)
def composite_key(t):
    return t.role("raw_bed", "CNES", "COMPETEN").select(
        cf.composite_key(c("CNES"), c("COMPETEN")).alias("cnes_competen")
    )


@query(
    "clean_admissions",
    f"""with d as (select *, {sql_admission_age("IDADE", "COD_IDADE")} as age, try_cast(ANO_CMPT as int) as y,
          try_cast(MES_CMPT as int) as m, try_cast(UTI_MES_TO as int) as icu from {RAW} where N_AIH is not null)
        select try_cast(N_AIH as bigint) as n_aih, CNES as cnes, y as ano, m as mes, {sql_period("y", "m")} as competencia,
          DIAG_PRINC as cid_principal, case when length(DIAG_PRINC) >= 3 then left(DIAG_PRINC, 3) end as cid3,
          regexp_matches(DIAG_PRINC, '{SENSITIVE_REGEX}') as csap_flag, try_cast(SEXO as int) as sexo,
          age as idade_anos, {sql_band("age")} as faixa_etaria, RACA_COR as raca_cor, MUNIC_RES as munic_res,
          MUNIC_MOV as munic_mov, CEP as cep, {sql_ymd("DT_INTER")} as dt_inter, {sql_ymd("DT_SAIDA")} as dt_saida,
          try_cast(DIAS_PERM as int) as dias_perm, try_cast(MORTE as int) as morte,
          try_cast(VAL_TOT as double) as val_tot, try_cast(VAL_SH as double) as val_sh,
          try_cast(VAL_SP as double) as val_sp, try_cast(VAL_UTI as double) as val_uti, icu as uti_dias,
          case when icu > 0 then 1 else 0 end as uso_uti, MARCA_UTI as marca_uti, PROC_REA as proc_rea,
          ESPEC as especialidade, CAR_INT as carater, COMPLEX as complexidade, COBRANCA as cobranca from d""",
)
def admissions(t):
    return clean_admissions(t.role("raw_admission"))


# Raw registry rows, one per supplier and month: the columns that matter here, and
# filler codes for the others.
_RAW_FACILITY = {name: f"'{name.lower()}' || cast(k % 3 as string)" for name in RAW_FACILITIES} | {
    "CNES": "case when k % 50 = 49 then null else lpad(cast(k as string), 7, '0') end",
    "CODUFMUN": "cast(430000 + k % 25 as string)",
    "COMPETEN": "cast(p as string)",
    "QTLEITP1": "cast(k % 40 as string)",
    "QTLEITP2": "''",
    "QTLEITP3": "case when k % 2 = 0 then '3.5' else '2' end",
    "TP_UNID": "lpad(cast(1 + (k + p) % 7 as string), 2, '0')",
    "ESFERA_A": "case when k % 3 = 0 then 'M' else 'E' end",
}


def raw_facility_rows(t):
    base = t("lineitem").selectExpr(
        "l_suppkey as k", "year(l_shipdate) * 100 + month(l_shipdate) as p"
    ).distinct()
    return base.selectExpr(*[f"{e} as {n}" for n, e in _RAW_FACILITY.items()])


_RAW_FAC_BASE = (
    "(select distinct l_suppkey as k, year(l_shipdate) * 100 + month(l_shipdate) as p from lineitem)"
)
_RAW_FAC_SQL = ", ".join(f"{e} as {n}" for n, e in _RAW_FACILITY.items())


@query(
    "clean_facilities",
    f"""with r as (select {_RAW_FAC_SQL} from {_RAW_FAC_BASE} b)
        select CNES as cnes, CODUFMUN as codufmun, cast(left(COMPETEN, 4) as int) as ano,
          cast(right(COMPETEN, 2) as int) as mes, make_date(cast(left(COMPETEN, 4) as int), cast(right(COMPETEN, 2) as int), 1) as competencia,
          {", ".join(f"{a} as {b}" for a, b in FACILITY_RENAMES.items())},
          try_cast(QTLEITP1 as int) as qt_leitos_cirurgicos, try_cast(QTLEITP2 as int) as qt_leitos_clinicos,
          try_cast(QTLEITP3 as int) as qt_leitos_complementares,
          CNES || '|' || left(COMPETEN, 4) || '-' || right(COMPETEN, 2) as cnes_competen
        from r where CNES is not null""",
)
def facilities(t):
    return clean_facilities(raw_facility_rows(t))


@query(
    "clean_beds",
    f"""select CNES as cnes, CODUFMUN as codufmun, cast(left(COMPETEN, 4) as int) as ano,
          cast(right(COMPETEN, 2) as int) as mes,
          make_date(cast(left(COMPETEN, 4) as int), cast(right(COMPETEN, 2) as int), 1) as competencia,
          TP_LEITO as tp_leito, CODLEITO as codleito, {_BED_SQL} as categoria, try_cast(QT_EXIST as int) as qt_exist,
          try_cast(QT_CONTR as int) as qt_contr, try_cast(QT_SUS as int) as qt_sus, try_cast(QT_NSUS as int) as qt_nsus
        from {role_sql("raw_bed")} b where CNES is not null""",
)
def beds(t):
    return clean_beds(t.role("raw_bed"))


@query(
    "clean_deaths",
    f"""with d as (select *, {sql_dmy("DTOBITO")} as died, left(CAUSABAS, 1) as ch from {RAW_DEATH} where DTOBITO is not null)
        select try_cast(CONTADOR as bigint) as contador, NUMEROLOTE as numero_lote, ORIGEM as origem, TIPOBITO as tipobito,
          died as dt_obito, cast(year(died) as int) as ano, cast(month(died) as int) as mes, {sql_dmy("DTNASC")} as dt_nasc,
          {sql_packed_age("IDADE")} as idade_anos, SEXO as sexo, RACACOR as raca_cor, cast(ESTCIV as varchar) as estado_civil,
          ESC2010 as escolaridade, cast(OCUP as varchar) as ocupacao, IDADE as idade_raw, CODMUNRES as munic_res,
          CODMUNOCOR as munic_ocor, LOCOCOR as local_ocorrencia, CODESTAB as cnes_estab,
          cast(ESTABDESCR as varchar) as estab_descr, CAUSABAS as causa_basica,
          case when length(CAUSABAS) >= 3 then left(CAUSABAS, 3) end as cid3, ch as capitulo_cid,
          case when ch in ('V', 'W', 'X', 'Y') then 1 else 0 end as causa_externa,
          case when ch = 'O' then 1 else 0 end as causa_materna, CAUSABAS_O as causa_basica_original,
          case when TIPOBITO = '1' then 1 else 0 end as obito_fetal,
          case when LOCOCOR = '1' then 1 else 0 end as obito_hospitalar, ASSISTMED as assistencia_medica,
          NECROPSIA as necropsia, cast(STDOEPIDEM as varchar) as investigado_epidemio, LINHAA,
          cast(LINHAB as varchar) as LINHAB, cast(LINHAC as varchar) as LINHAC, cast(LINHAD as varchar) as LINHAD,
          cast(LINHAII as varchar) as LINHAII, ATESTADO as atestado_texto from d""",
)
def deaths(t):
    raw = t.role("raw_death")
    nulls = [n for n, kind in raw.dtypes if kind == "void"]
    return clean_deaths(raw.withColumns({n: c(n).cast("string") for n in nulls}))


@query(
    "transfer_flag",
    f"select id_aih, munic_res <> munic_mov as transferido from {adm('id_aih', 'munic_res', 'munic_mov')} a",
)
def transfer_flag(t):
    from carelake.operators.explore import transferred

    return transferred(t.admissions("id_aih", "munic_res", "munic_mov")).select(
        "id_aih", "transferido"
    )


@query(
    "weekday_features",
    """select o_orderkey, strftime(o_orderdate, '%a') as dow_inter, cast(dayofmonth(o_orderdate) as int) as dom_inter,
       cast(dayofweek(o_orderdate) as int) as dow_admissao from orders""",
)
def weekday_features(t):
    day = c("o_orderdate")
    return t("orders").select(
        "o_orderkey",
        F.date_format(day, "E").alias("dow_inter"),
        F.dayofmonth(day).alias("dom_inter"),
        cf.dow_sunday0(day).alias("dow_admissao"),
    )


@query(
    "stay_days",
    f"""select N_AIH as n_aih, cast(date_diff('day', {sql_ymd("DT_INTER")}, {sql_ymd("DT_SAIDA")}) as int) as dias
        from {RAW}""",
)
def stay_days(t):
    return t.role("raw_admission", "N_AIH", "DT_INTER", "DT_SAIDA").select(
        c("N_AIH").alias("n_aih"),
        cf.stay_days(cf.parse_ymd(c("DT_INTER")), cf.parse_ymd(c("DT_SAIDA"))).alias("dias"),
    )


_CEP = (
    "case o_orderkey % 5 when 0 then null when 1 then '9003' when 2 then "
    "'90.' || lpad(cast(o_orderkey % 1000 as string), 3, '0') || '-001' "
    "else cast(90000000 + o_orderkey as string) end"
)


@query(
    "postcode_prefix",
    f"""select o_orderkey, case when length(d) >= 5 then left(d, 5) else '' end as cep_prefix from
        (select o_orderkey, regexp_replace(coalesce({_CEP}, ''), '[^0-9]', '', 'g') as d from orders) x""",
)
def postcode_prefix(t):
    return t("orders").selectExpr("o_orderkey", f"{_CEP} as cep").select(
        "o_orderkey", cf.postcode_prefix(c("cep")).alias("cep_prefix")
    )


# Part names with Portuguese letters and outer blanks.
_NAME = "' ' || replace(replace(replace(upper(p_name), 'A', 'Ã'), 'E', 'É'), 'U', 'Ü') || ' Ç '"


@query(
    "accent_key",
    f"select p_partkey, strip_accents(lower(trim({_NAME}))) as chave from part",
)
def accent_key(t):
    return t("part").selectExpr("p_partkey", f"{_NAME} as nome").select(
        "p_partkey", cf.accent_key(c("nome")).alias("chave")
    )


_LOCALE = (
    "case o_orderkey % 4 when 0 then '' when 1 then cast(o_orderkey % 900 + 1 as string) || '.' || "
    "lpad(cast(o_custkey % 1000 as string), 3, '0') when 2 then cast(o_orderkey % 100 as string) || ',' || "
    "cast(10 + o_custkey % 90 as string) else 'n/d' end"
)


@query(
    "locale_number",
    f"""select o_orderkey, case when p = '' then 0.0::double else try_cast(p as double) end as valor from
        (select o_orderkey, replace(replace(trim({_LOCALE}), '.', ''), ',', '.') as p from orders) x""",
)
def locale_number(t):
    return t("orders").selectExpr("o_orderkey", f"{_LOCALE} as texto").select(
        "o_orderkey", cf.br_number(c("texto")).alias("valor")
    )


@query(
    "truncate_code",
    "select o_orderkey, left(cast(4300000 + o_custkey % 99999 as varchar), 6) as cod6 from orders",
)
def truncate_code(t):
    return t("orders").select(
        "o_orderkey", cf.truncate_code(F.lit(4300000) + c("o_custkey") % 99999).alias("cod6")
    )


def _quality_input(t):
    return t.role("raw_admission", "N_AIH", "SEXO", "NASC", "DT_INTER", "DT_SAIDA", "MORTE").select(
        c("N_AIH").alias("n_aih"),
        F.when(c("SEXO") == "x", 9).otherwise(cf.to_int(c("SEXO"))).alias("sexo"),
        c("NASC").alias("dt_nasc_raw"),
        cf.parse_ymd(c("DT_INTER")).alias("dt_inter"),
        cf.parse_ymd(c("DT_SAIDA")).alias("dt_saida"),
        cf.to_int(c("MORTE")).alias("morte"),
    )


_QUALITY = f"""(select N_AIH as n_aih, case when SEXO = 'x' then 9 else try_cast(SEXO as int) end as sexo, NASC as raw,
    {sql_ymd("NASC")} as b, {sql_ymd("DT_INTER")} as i, {sql_ymd("DT_SAIDA")} as o, try_cast(MORTE as int) as morte from {RAW}) q"""


@query(
    "quality_rules",
    f"""select n_aih, case when sexo not in (0, 9) then sexo end as sexo, case when b <= date '2000-06-30' then b end as dt_nasc,
        i as dt_inter, o as dt_saida, morte from {_QUALITY}
        where not coalesce(o < i, false) and not (coalesce(morte = 1, false) and o is null)""",
)
def quality_rules(t):
    return apply_quality_rules(_quality_input(t), "2000-06-30")[0]


@query(
    "quality_rejects",
    f"""select count(*) as linhas, count(*) filter (o < i) as saida_antes_entrada,
        count(*) filter (morte = 1 and o is null) as obito_sem_saida, count(*) filter (sexo in (0, 9)) as sexo_desconhecido,
        count(*) filter (b is null or b > date '2000-06-30') as nascimento_invalido from {_QUALITY}""",
)
def quality_rejects(t):
    return apply_quality_rules(_quality_input(t), "2000-06-30")[1]


@query(
    "pseudonymise",
    "select sha256(cast(o_orderkey as varchar)) as n_aih_hash, o_orderstatus from orders",
)
def pseudonymise(t):
    return t("orders").select(cf.pseudonym(c("o_orderkey")).alias("n_aih_hash"), "o_orderstatus")


@query(
    "zero_pad",
    "select c_custkey, lpad(cast(c_custkey * 7919 as varchar), 14, '0') as cpf_cnpj from customer",
)
def zero_pad(t):
    return t("customer").select(
        "c_custkey", cf.zero_pad(c("c_custkey") * 7919, 14).alias("cpf_cnpj")
    )


_LAT = "case when c_custkey % 3 = 0 then 0.0 when c_custkey % 10 = 1 then null else -30.0 - c_nationkey / 10.0 end"
_LON = "case when c_custkey % 6 = 0 then 0.0 else -51.0 - c_nationkey / 10.0 end"


@query(
    "null_sentinel",
    f"""select c_custkey, case when ok then lat end as lat, case when ok then lon end as lon from (select *,
        coalesce(lat is not null and lon is not null and not (lat = 0 and lon = 0), false) as ok from
        (select c_custkey, cast({_LAT} as double) as lat, cast({_LON} as double) as lon from customer) x) y""",
)
def null_sentinel(t):
    lat, lon = cf.null_coordinates(c("lat"), c("lon"))
    return (
        t("customer")
        .selectExpr("c_custkey", f"cast({_LAT} as double) as lat", f"cast({_LON} as double) as lon")
        .select("c_custkey", lat.alias("lat"), lon.alias("lon"))
    )


@query(
    "id_fallback",
    """select c_custkey, case when c_custkey % 4 = 0 then 'M' || cast(c_nationkey as varchar)
       else lpad(cast(c_custkey as varchar), 14, '0') end as cnpj from customer""",
)
def id_fallback(t):
    own = F.when(c("c_custkey") % 4 == 0, "0" * 14).otherwise(cf.zero_pad(c("c_custkey"), 14))
    keeper = F.concat(F.lit("M"), c("c_nationkey").cast("string"))
    return t("customer").select("c_custkey", cf.id_or_fallback(own, keeper).alias("cnpj"))


_WEEK = (
    "case when o_orderkey % 50 = 0 then 'semana' else "
    "cast(year(o_orderdate) * 100 + 1 + (o_orderkey % 53) as string) end"
)


@query(
    "epi_week_split",
    f"""select o_orderkey, try_cast(left(w, 4) as int) as ano_epi, try_cast(substr(w, 5, 2) as int) as semana_epi
        from (select o_orderkey, {_WEEK} as w from orders) x""",
)
def epi_week_split(t):
    return t("orders").selectExpr("o_orderkey", f"{_WEEK} as w").select(
        "o_orderkey", cf.epi_year(c("w")).alias("ano_epi"), cf.epi_week(c("w")).alias("semana_epi")
    )


_DISEASE = "case o_custkey % 3 when 0 then 'DENG' when 1 then 'HEPA' else 'VARC' end"
_CLASS = "case when o_orderkey % 17 = 0 then null else cast(1 + o_orderkey % 13 as string) end"


@query(
    "class_lookup",
    f"""select o_orderkey, doenca, {sql_map("doenca || ':' || classe", {f"{d}:{k}": v for (d, k), v in OUTCOME_CLASSES.items()})}
        as significado from (select o_orderkey, {_DISEASE} as doenca, {_CLASS} as classe from orders) x""",
)
def class_lookup(t):
    return t("orders").selectExpr(
        "o_orderkey", f"{_DISEASE} as doenca", f"{_CLASS} as classe"
    ).select(
        "o_orderkey", "doenca", cf.outcome_label(c("doenca"), c("classe")).alias("significado")
    )
