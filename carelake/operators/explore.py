"""Exploratory rates, rankings and checks over admissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake import functions as cf
from carelake.functions.codes import URGENT_CODES
from carelake.operators.quantiles import with_quantiles
from carelake.operators.windows import top_rows


def _n() -> Column:
    return F.count(F.lit(1))


def _death_rate() -> Column:
    return cf.percent(F.sum("morte"), _n())


def rate_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows, deaths and death percentage per group."""
    return df.groupBy(*keys).agg(
        _n().alias("n"), F.sum("morte").alias("obitos"), _death_rate().alias("tx_mort_pct")
    )


def rate_by_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """rate_by for each key on its own, as (grupo, valor) rows, in one scan.

    Rows are folded to the combinations of the keys before those are unpivoted, so
    this suits keys of few values; use rate_by for a key of many.
    """
    cells = _folded(df, keys, [])
    pairs = [
        F.struct(F.lit(k).alias("grupo"), F.col(k).cast("string").alias("valor")) for k in keys
    ]
    return (
        cells.select("_n", "_d", F.explode(F.array(*pairs)).alias("_p"))
        .groupBy("_p.grupo", "_p.valor")
        .agg(
            F.sum("_n").alias("n"),
            F.sum("_d").alias("obitos"),
            cf.percent(F.sum("_d"), F.sum("_n")).alias("tx_mort_pct"),
        )
    )


def volume_by_period(df: DataFrame, year: str = "ano", month: str = "mes") -> DataFrame:
    return df.groupBy(year, month).agg(_n().alias("n")).orderBy(year, month)


def _folded(df: DataFrame, dims: list[str], extra: list[Column]) -> DataFrame:
    """Rows folded to their dimension combinations, so that several distinct
    counts expand the folded table rather than every row."""
    return df.groupBy(*dims).agg(_n().alias("_n"), F.sum("morte").alias("_d"), *extra)


def overview(adm: DataFrame) -> DataFrame:
    folded = _folded(adm, ["munic_res", "munic_mov", "cnes"], [])
    return folded.agg(
        F.countDistinct("munic_res").alias("munic_res"),
        F.countDistinct("munic_mov").alias("munic_atend"),
        F.countDistinct("cnes").alias("hospitais"),
        F.sum("_d").alias("obitos_totais"),
        cf.percent(F.sum("_d"), F.sum("_n")).alias("tx_mort_pct_geral"),
    )


def synthesis(adm: DataFrame) -> DataFrame:
    folded = _folded(
        adm,
        ["munic_res", "munic_mov", "cnes", "cid_principal"],
        [F.min("dt_inter").alias("_first"), F.max("dt_inter").alias("_last")],
    )
    return folded.agg(
        F.sum("_n").alias("internacoes"),
        F.sum("_d").alias("obitos"),
        F.countDistinct("munic_res").alias("munic_res"),
        F.countDistinct("munic_mov").alias("munic_atend"),
        F.countDistinct("cnes").alias("hospitais"),
        F.countDistinct("cid_principal").alias("cids"),
        F.min("_first").alias("primeira_internacao"),
        F.max("_last").alias("ultima_internacao"),
    )


def care_places(adm: DataFrame, n: int = 15) -> DataFrame:
    """Municipalities of care by volume, with their number of hospitals."""
    c = F.col
    per_place = (
        _folded(adm, ["munic_mov", "cnes"], [])
        .groupBy("munic_mov")
        .agg(
            F.sum("_n").alias("n"),
            F.sum("_d").alias("obitos"),
            cf.percent(F.sum("_d"), F.sum("_n")).alias("tx_mort_pct"),
            F.countDistinct("cnes").alias("hospitais"),
        )
    )
    return top_rows(per_place, [c("n").desc(), c("munic_mov")], n)


def rate_extremes(
    df: DataFrame, key: str, min_n: int, n: int = 10, highest: bool = True
) -> DataFrame:
    """Groups with at least min_n rows, highest or lowest death rate first."""
    c = F.col
    rate = c("tx_mort_pct")
    order = [rate.desc_nulls_last() if highest else rate.asc_nulls_last(), c(key)]
    return top_rows(rate_by(df, key).where(c("n") >= min_n), order, n)


STAY_PROBS = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}


def stay_quantiles(adm: DataFrame, keys: list[str]) -> DataFrame:
    """Minimum, quartiles, p95, maximum and mean of the stay, per group."""
    basic = adm.groupBy(*keys).agg(
        _n().alias("n"),
        F.min("dias_perm").alias("min"),
        F.max("dias_perm").alias("max"),
        F.avg("dias_perm").alias("mean"),
    )
    return with_quantiles(basic, adm, keys, "dias_perm", STAY_PROBS)


def transferred(df: DataFrame) -> DataFrame:
    """Cared for outside the municipality of residence; NULL when either is unknown."""
    return df.withColumn("transferido", F.col("munic_res") != F.col("munic_mov"))


def flow_destinations(adm: DataFrame, n: int = 10) -> DataFrame:
    c = F.col
    flows = _folded(transferred(adm).where(c("transferido")), ["munic_mov", "munic_res"], [])
    per_place = flows.groupBy("munic_mov").agg(
        F.sum("_n").alias("recebidos"),
        F.count("munic_res").alias("munic_origem"),
        cf.percent(F.sum("_d"), F.sum("_n")).alias("tx_mort_transf"),
    )
    return top_rows(per_place, [c("recebidos").desc(), c("munic_mov")], n)


def flow_origins(adm: DataFrame, n: int = 10) -> DataFrame:
    c = F.col
    flows = _folded(transferred(adm).where(c("transferido")), ["munic_res", "munic_mov"], [])
    per_place = flows.groupBy("munic_res").agg(
        F.sum("_n").alias("exportados"), F.count("munic_mov").alias("destinos")
    )
    return top_rows(per_place, [c("exportados").desc(), c("munic_res")], n)


def urgent_transfer(adm: DataFrame, codes=URGENT_CODES) -> DataFrame:
    urgent = transferred(adm.where(F.col("cid_principal").isin(*codes)))
    return rate_by(urgent, "cid_principal", "transferido").orderBy("cid_principal", "transferido")


def observed_expected(adm: DataFrame, min_n: int = 500) -> DataFrame:
    """Deaths by hospital against those expected from its mix of chapters.

    Every row of a (hospital, chapter) cell expects the same rate, so the cells
    are joined to the chapter rates instead of the rows: n * rate, not a sum over
    rows. Rows with no chapter have no expectation and are left out.
    """
    c = F.col
    cells = (
        adm.where(c("cid_cap").isNotNull())
        .groupBy("cnes", "cid_cap")
        .agg(_n().alias("_n"), F.sum("morte").alias("_d"))
    )
    rates = cells.groupBy("cid_cap").agg(
        cf.guarded_ratio(F.sum("_d"), F.sum("_n")).alias("_rate")
    )
    return (
        cells.join(rates, "cid_cap")
        .groupBy("cnes")
        .agg(
            F.sum("_n").alias("n"),
            F.sum("_d").alias("obitos_obs"),
            F.sum(c("_n") * c("_rate")).alias("obitos_esp"),
        )
        .where(c("n") >= min_n)
        .withColumn("tx_obs_pct", cf.percent(c("obitos_obs"), c("n")))
        .withColumn("tx_esp_pct", cf.percent(c("obitos_esp"), c("n")))
        .withColumn("excesso_pp", c("tx_obs_pct") - c("tx_esp_pct"))
    )


def excess_extremes(table: DataFrame, n: int = 10, worst: bool = True) -> DataFrame:
    excess = F.col("excesso_pp")
    return top_rows(table, [excess.desc() if worst else excess.asc(), F.col("cnes")], n)


def silence_proxy(
    adm: DataFrame,
    min_n: int = 1000,
    min_export_pct: float = 70,
    min_death_pct: float = 5.6,
    n: int = 15,
) -> DataFrame:
    """Municipalities that send most patients away and lose many of them."""
    c = F.col
    per_place = (
        transferred(adm)
        .groupBy("munic_res")
        .agg(
            _n().alias("internacoes_residentes"),
            F.sum(cf.flag(c("transferido"))).alias("exportados"),
            F.sum("morte").alias("obitos"),
            _death_rate().alias("tx_mort_pct"),
        )
        .withColumn("pct_exportado", cf.percent(c("exportados"), c("internacoes_residentes")))
        .where(c("internacoes_residentes") >= min_n)
        .where((c("pct_exportado") > min_export_pct) & (c("tx_mort_pct") > min_death_pct))
    )
    return top_rows(per_place, [c("tx_mort_pct").desc(), c("munic_res")], n)


def age_sanity(df: DataFrame, age: str = "idade") -> DataFrame:
    c = F.col(age)
    return df.agg(
        F.min(c).alias("min_idade"),
        F.max(c).alias("max_idade"),
        F.count_if(c < 0).alias("idade_negativa"),
        F.count_if(c > 110).alias("idade_maior_110"),
    )


# Reading order of the week.
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def weekday_distribution(df: DataFrame, day: str) -> DataFrame:
    """All seven weekdays in order, with counts and shares; an absent day has no count."""
    c = F.col
    number = F.weekday(day)
    wide = df.agg(*[F.count_if(number == i).alias(d) for i, d in enumerate(WEEKDAYS)])
    total = sum((c(d) for d in WEEKDAYS[1:]), c(WEEKDAYS[0]))
    pairs = [
        F.struct(
            F.lit(i + 1).alias("ordem"),
            F.lit(d).alias("dow"),
            F.when(c(d) > 0, c(d)).alias("n"),
        )
        for i, d in enumerate(WEEKDAYS)
    ]
    return (
        wide.select(total.alias("_total"), F.explode(F.array(*pairs)).alias("_p"))
        .select("_p.ordem", "_p.dow", "_p.n", cf.percent(c("_p.n"), c("_total")).alias("pct"))
        .orderBy("ordem")
    )


def month_day_distribution(df: DataFrame, day: str) -> DataFrame:
    counts = df.groupBy(F.dayofmonth(day).alias("dom")).agg(_n().alias("n"))
    # At most 32 rows are left for the total.
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("pct", cf.percent(F.col("n"), total)).orderBy("dom")


def distinct_people(staff: DataFrame, code_prefix: str = "22") -> DataFrame:
    """People per facility and month, each once however many contracts they hold."""
    c = F.col
    return (
        staff.where(c("cbo").startswith(code_prefix))
        .groupBy("cnes", "competen")
        .agg(F.countDistinct("pessoa").alias("n_medicos"))
    )


def beds_per_facility(beds: DataFrame) -> DataFrame:
    """Public beds per facility and month, over all its bed types."""
    return beds.groupBy("cnes", "competen").agg(F.sum("qt_sus").alias("leitos_sus"))


def conditional_sum(equipment: DataFrame, code: str = "44") -> DataFrame:
    """Units in use of one equipment code that are open to the public network."""
    c = F.col
    return (
        equipment.where((c("codequip") == code) & (c("ind_sus") == "1"))
        .groupBy("codufmun")
        .agg(F.sum("qt_uso").alias("qt_uso"))
    )
