"""Raw text records to typed, derived tables (narrow maps: no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake import functions as cf
from carelake.schemas import FACILITY_RENAMES


def clean_admissions(raw: DataFrame) -> DataFrame:
    """One row per admission, 31 columns."""
    c = F.col
    year, month = cf.to_int(c("ANO_CMPT")), cf.to_int(c("MES_CMPT"))
    icu_days = cf.to_int(c("UTI_MES_TO"))
    # The decoded age feeds two columns, so it is computed in a first projection.
    typed = raw.where(c("N_AIH").isNotNull()).withColumn(
        "_age", cf.decode_admission_age(c("IDADE"), c("COD_IDADE"))
    )
    return typed.select(
        cf.to_long(c("N_AIH")).alias("n_aih"),
        c("CNES").cast("string").alias("cnes"),
        year.alias("ano"),
        month.alias("mes"),
        cf.period_date(year, month).alias("competencia"),
        c("DIAG_PRINC").alias("cid_principal"),
        cf.code_group(c("DIAG_PRINC")).alias("cid3"),
        cf.is_sensitive(c("DIAG_PRINC")).alias("csap_flag"),
        cf.to_int(c("SEXO")).alias("sexo"),
        c("_age").alias("idade_anos"),
        cf.age_band(c("_age")).alias("faixa_etaria"),
        c("RACA_COR").alias("raca_cor"),
        c("MUNIC_RES").cast("string").alias("munic_res"),
        c("MUNIC_MOV").cast("string").alias("munic_mov"),
        c("CEP").cast("string").alias("cep"),
        cf.parse_ymd(c("DT_INTER")).alias("dt_inter"),
        cf.parse_ymd(c("DT_SAIDA")).alias("dt_saida"),
        cf.to_int(c("DIAS_PERM")).alias("dias_perm"),
        cf.to_int(c("MORTE")).alias("morte"),
        cf.to_double(c("VAL_TOT")).alias("val_tot"),
        cf.to_double(c("VAL_SH")).alias("val_sh"),
        cf.to_double(c("VAL_SP")).alias("val_sp"),
        cf.to_double(c("VAL_UTI")).alias("val_uti"),
        icu_days.alias("uti_dias"),
        cf.flag(icu_days > 0).alias("uso_uti"),
        c("MARCA_UTI").alias("marca_uti"),
        c("PROC_REA").alias("proc_rea"),
        c("ESPEC").alias("especialidade"),
        c("CAR_INT").alias("carater"),
        c("COMPLEX").alias("complexidade"),
        c("COBRANCA").alias("cobranca"),
    )


def _period_columns():
    period = F.col("COMPETEN")
    return [
        cf.period_year(period).alias("ano"),
        cf.period_month(period).alias("mes"),
        cf.reference_month(period).alias("competencia"),
    ]


def clean_facilities(raw: DataFrame) -> DataFrame:
    """Facility registry, one row per facility and month, 36 columns."""
    c = F.col
    return raw.where(c("CNES").isNotNull()).select(
        c("CNES").cast("string").alias("cnes"),
        c("CODUFMUN").cast("string").alias("codufmun"),
        *_period_columns(),
        *[c(src).cast("string").alias(dst) for src, dst in FACILITY_RENAMES.items()],
        cf.to_int(c("QTLEITP1")).alias("qt_leitos_cirurgicos"),
        cf.to_int(c("QTLEITP2")).alias("qt_leitos_clinicos"),
        cf.to_int(c("QTLEITP3")).alias("qt_leitos_complementares"),
        cf.composite_key(c("CNES"), c("COMPETEN")).alias("cnes_competen"),
    )


def clean_beds(raw: DataFrame, padded_types: bool = False) -> DataFrame:
    """Beds per facility, month and bed type, 12 columns."""
    c = F.col
    return raw.where(c("CNES").isNotNull()).select(
        c("CNES").cast("string").alias("cnes"),
        c("CODUFMUN").cast("string").alias("codufmun"),
        *_period_columns(),
        c("TP_LEITO").cast("string").alias("tp_leito"),
        c("CODLEITO").cast("string").alias("codleito"),
        cf.bed_category(c("CODLEITO"), c("TP_LEITO"), padded_types).alias("categoria"),
        *[cf.to_int(c(q)).alias(q.lower()) for q in ("QT_EXIST", "QT_CONTR", "QT_SUS", "QT_NSUS")],
    )


def clean_deaths(raw: DataFrame) -> DataFrame:
    """Death certificates, 37 columns; dates arrive day first."""
    c = F.col
    text = lambda name: c(name).cast("string")
    died = cf.parse_dmy(c("DTOBITO"))
    cause = c("CAUSABAS")
    return raw.where(c("DTOBITO").isNotNull()).select(
        cf.to_long(c("CONTADOR")).alias("contador"),
        text("NUMEROLOTE").alias("numero_lote"),
        text("ORIGEM").alias("origem"),
        text("TIPOBITO").alias("tipobito"),
        died.alias("dt_obito"),
        F.year(died).alias("ano"),
        F.month(died).alias("mes"),
        cf.parse_dmy(c("DTNASC")).alias("dt_nasc"),
        cf.decode_packed_age(c("IDADE")).alias("idade_anos"),
        text("SEXO").alias("sexo"),
        text("RACACOR").alias("raca_cor"),
        text("ESTCIV").alias("estado_civil"),
        text("ESC2010").alias("escolaridade"),
        text("OCUP").alias("ocupacao"),
        text("IDADE").alias("idade_raw"),
        text("CODMUNRES").alias("munic_res"),
        text("CODMUNOCOR").alias("munic_ocor"),
        text("LOCOCOR").alias("local_ocorrencia"),
        text("CODESTAB").alias("cnes_estab"),
        c("ESTABDESCR").alias("estab_descr"),
        cause.alias("causa_basica"),
        cf.code_group(cause).alias("cid3"),
        cf.code_chapter(cause).alias("capitulo_cid"),
        cf.flag(cf.is_external_cause(cause)).alias("causa_externa"),
        cf.flag(cf.code_chapter(cause) == "O").alias("causa_materna"),
        c("CAUSABAS_O").alias("causa_basica_original"),
        cf.flag(c("TIPOBITO") == "1").alias("obito_fetal"),
        cf.flag(c("LOCOCOR") == "1").alias("obito_hospitalar"),
        c("ASSISTMED").alias("assistencia_medica"),
        c("NECROPSIA").alias("necropsia"),
        c("STDOEPIDEM").alias("investigado_epidemio"),
        *[c(line) for line in ("LINHAA", "LINHAB", "LINHAC", "LINHAD", "LINHAII")],
        c("ATESTADO").alias("atestado_texto"),
    )


def apply_quality_rules(adm: DataFrame, today=None) -> tuple[DataFrame, DataFrame]:
    """Kept rows with repaired values, and a one-row table of rule hits.

    Needs sexo, dt_nasc_raw, dt_inter, dt_saida and morte. Rows whose exit comes
    before entry, and deaths with no exit date, are dropped; an unknown sex and
    an impossible birth date become NULL.
    """
    c = F.col
    limit = F.lit(today).cast("date") if today else F.current_date()
    birth = cf.parse_ymd(c("dt_nasc_raw"))
    bad_sex = F.coalesce(c("sexo").isin(0, 9), F.lit(False))
    bad_birth = c("dt_nasc_raw").isNotNull() & F.coalesce(
        (c("dt_nasc_raw") == "00000000") | birth.isNull() | (birth > limit), F.lit(False)
    )
    reversed_stay = F.coalesce(c("dt_saida") < c("dt_inter"), F.lit(False))
    open_death = F.coalesce(c("morte") == 1, F.lit(False)) & c("dt_saida").isNull()
    kept = (
        adm.where(~reversed_stay & ~open_death)
        .withColumn("sexo", F.when(~bad_sex, c("sexo")))
        .withColumn("dt_nasc", F.when(~bad_birth, birth))
        .drop("dt_nasc_raw")
    )
    hits = adm.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_if(reversed_stay).alias("saida_antes_entrada"),
        F.count_if(open_death).alias("obito_sem_saida"),
        F.count_if(bad_sex).alias("sexo_desconhecido"),
        F.count_if(bad_birth).alias("nascimento_invalido"),
    )
    return kept, hits
