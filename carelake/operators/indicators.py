"""Documented indicators built from the aggregated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake import functions as cf
from carelake.operators.explore import transferred


def threshold_indicators(births: DataFrame, keys: list[str]) -> DataFrame:
    """Low weight, low Apgar at 5 minutes and adequate prenatal shares among births
    of plausible weight (500 to 6000 g)."""
    c = F.col
    share = lambda cond: F.avg(F.when(cond, 1.0).when(~cond, 0.0))
    return (
        births.where(c("peso").between(500, 6000))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("nascimentos"),
            share(c("peso") < 2500).alias("baixo_peso"),
            share(c("apgar5") < 7).alias("apgar5_baixo"),
            share(c("consultas") == "4").alias("prenatal_adequado"),
        )
    )


def confirmed_cases(notifications: DataFrame, state: str) -> DataFrame:
    """Confirmed final classes, notified in and resident of the state."""
    c = F.col
    return notifications.where(
        c("classi_fin").isin("1", "5") & (c("sg_uf_not") == state) & (c("sg_uf") == state)
    )


def event_latency(notifications: DataFrame, state: str) -> DataFrame:
    return confirmed_cases(notifications, state).withColumn(
        "latencia_dias", F.datediff(F.col("dt_transf"), F.col("dt_notific"))
    )


def type_distribution(registry: DataFrame, types: list[str]) -> DataFrame:
    """Facilities per municipality, one column per unit type."""
    return (
        registry.groupBy("codufmun")
        .pivot("tp_unid", types)
        .agg(F.countDistinct("cnes"))
        .na.fill(0, subset=types)
        .select("codufmun", *[F.col(f"`{t}`").alias(f"tipo_{t}") for t in types])
    )


def uncovered(registry: DataFrame, places: DataFrame, unit_type: str) -> DataFrame:
    """Municipalities with no facility of the given type."""
    covered = registry.where(F.col("tp_unid") == unit_type).select("codufmun").distinct()
    return places.join(covered, "codufmun", "left_anti")


def below_norm(capacity: DataFrame, norm: float = 3.0) -> DataFrame:
    return capacity.where(F.col("leitos_sus_por_1000hab") < norm)


def traceability(adm: DataFrame, salt: str | None = None) -> DataFrame:
    """Per facility and month: volume, mortality, share of patients from elsewhere.
    The facility is identified by its pseudonym."""
    c = F.col
    n = F.count(F.lit(1))
    return (
        transferred(adm)
        .groupBy("cnes", "ano", "mes")
        .agg(
            n.alias("internacoes"),
            cf.percent(F.sum("morte"), n).alias("tx_mort_pct"),
            cf.percent(F.sum(cf.flag(c("transferido"))), n).alias("pct_fora_municipio"),
        )
        .withColumn("cnes_hash", cf.pseudonym(c("cnes"), salt))
        .drop("cnes")
    )


def silent_areas(areas: DataFrame, rate: str, beds: str) -> DataFrame:
    """Death rate above the regional P75 and beds below the regional P25.

    `areas` has one row per municipality (a few thousand), so the exact
    percentile is computed over it directly, as a scalar subquery.
    """
    high = areas.agg(F.percentile(rate, F.lit(0.75))).scalar()
    low = areas.agg(F.percentile(beds, F.lit(0.25))).scalar()
    return areas.where((F.col(rate) > high) & (F.col(beds) < low))


def funnel_outliers(counts: DataFrame, z: float = 1.96) -> DataFrame:
    """Groups outside the band expected for their volume.

    Normal approximation to the binomial around the overall rate, clipped to [0, 1].
    """
    c = F.col
    overall = counts.agg(F.sum("obitos").cast("double") / F.sum("n")).scalar()
    return (
        counts.withColumn("taxa", cf.guarded_ratio(c("obitos"), c("n")))
        .withColumn("taxa_geral", overall)
        .withColumn(
            "_half", F.sqrt(c("taxa_geral") * (1 - c("taxa_geral")) / c("n")) * F.lit(z)
        )
        .withColumn("limite_inf", F.greatest(c("taxa_geral") - c("_half"), F.lit(0.0)))
        .withColumn("limite_sup", F.least(c("taxa_geral") + c("_half"), F.lit(1.0)))
        .drop("_half")
        .withColumn(
            "situacao",
            F.when(c("taxa") > c("limite_sup"), "acima")
            .when(c("taxa") < c("limite_inf"), "abaixo")
            .otherwise("dentro"),
        )
    )


def stored_rate(mortality: DataFrame) -> DataFrame:
    """Refined form: periods as YYYYMM, rate 0 where there were no admissions."""
    c = F.col
    return mortality.select(
        c("cod6").alias("municipio"),
        F.concat(c("ano").cast("string"), F.lpad(c("mes").cast("string"), 2, "0")).alias(
            "competencia"
        ),
        c("internacoes").alias("total_internacoes"),
        c("obitos").alias("total_obitos"),
        F.round(cf.stored_percent(c("obitos"), c("internacoes")), 4).alias("taxa_mortalidade"),
    )


def stored_beds(capacity: DataFrame) -> DataFrame:
    """Refined form of bed availability: periods as YYYYMM, 0 where no population is known."""
    c = F.col
    rate = F.when(c("populacao") > 0, c("leitos_sus_total") / c("populacao") * 1000).otherwise(F.lit(0.0))
    return capacity.select(
        c("codufmun").alias("municipio"),
        F.concat(c("ano").cast("string"), F.lpad(c("mes").cast("string"), 2, "0")).alias("competencia"),
        c("leitos_sus_total").alias("total_leitos_sus"),
        c("populacao").alias("pop_estimada"),
        F.round(rate, 4).alias("leitos_por_1000hab"),
    )


def mortality_trend(mortality: DataFrame, min_months: int = 6) -> DataFrame:
    """Change of the death rate per month and its fit, by municipality, from the monthly
    table; municipalities with fewer months have no trend and are left out."""
    c = F.col
    month = (c("ano") * 12 + c("mes")).cast("double")
    rate = c("taxa_mortalidade")
    rated = mortality.where(rate.isNotNull())
    return (
        rated.groupBy("cod6")
        .agg(
            F.count(F.lit(1)).alias("meses"),
            F.regr_slope(rate, month).alias("pp_por_mes"),
            F.regr_r2(rate, month).alias("r2"),
        )
        .where(c("meses") >= min_months)
    )


def rejection_rate(flagged: DataFrame, keys: list[str]) -> DataFrame:
    """Rejected share of all presented admissions per group."""
    n = F.count(F.lit(1))
    rejected = F.sum("rejeitada")
    return flagged.groupBy(*keys).agg(
        n.alias("apresentadas"),
        rejected.alias("rejeitadas"),
        cf.percent(rejected, n).alias("pct_rejeitada"),
    )


def amount_gap(production: DataFrame, keys: list[str]) -> DataFrame:
    """Presented against approved amounts, and the share of rows where they differ."""
    c = F.col
    n = F.count(F.lit(1))
    money = lambda x: c(x).cast("decimal(18,2)")
    differs = F.count_if(money("presented") != money("approved"))
    return production.groupBy(*keys).agg(
        n.alias("linhas"),
        cf.money_sum(c("presented")).alias("valor_apresentado"),
        cf.money_sum(c("approved")).alias("valor_aprovado"),
        differs.alias("linhas_divergentes"),
        cf.percent(differs, n).alias("pct_divergente"),
    )


def correction_share(deaths: DataFrame, keys: list[str]) -> DataFrame:
    """Share of certificates whose final cause is not the original one."""
    c = F.col
    changed = ~c("causa_basica").eqNullSafe(c("causa_basica_original"))
    n = F.count(F.lit(1))
    return deaths.groupBy(*keys).agg(
        n.alias("obitos"),
        F.count_if(changed).alias("corrigidos"),
        cf.percent(F.count_if(changed), n).alias("pct_corrigido"),
    )


def source_gap(adm: DataFrame, deaths: DataFrame) -> DataFrame:
    """In-hospital deaths in admissions against the death registry, per facility and month."""
    c = F.col
    keys = ["cnes", "ano", "mes"]
    a = adm.groupBy(*keys).agg(F.sum("morte").alias("obitos_sih"))
    d = (
        deaths.where((c("local_ocorrencia") == "1") & c("cnes").isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("obitos_sim"))
    )
    zero = F.lit(0).cast("bigint")
    return (
        a.join(d, keys, "full")
        .select(
            *keys,
            F.coalesce("obitos_sih", zero).alias("obitos_sih"),
            F.coalesce("obitos_sim", zero).alias("obitos_sim"),
        )
        .withColumn("diferenca", c("obitos_sim") - c("obitos_sih"))
    )


def infant_rate(births: DataFrame, deaths: DataFrame) -> DataFrame:
    """Deaths under one year per 1000 births, by municipality and year."""
    c = F.col
    keys = ["munic_res", "ano"]
    born = births.groupBy(*keys).agg(F.count(F.lit(1)).alias("nascimentos"))
    lost = (
        deaths.where(c("idade_anos") < 1).groupBy(*keys).agg(F.count(F.lit(1)).alias("obitos"))
    )
    return born.join(lost, keys, "left").select(
        *keys,
        "nascimentos",
        F.coalesce("obitos", F.lit(0).cast("bigint")).alias("obitos_menor_1"),
        cf.guarded_ratio(
            F.coalesce("obitos", F.lit(0).cast("bigint")), c("nascimentos"), 1000
        ).alias("mortalidade_infantil"),
    )


def overlay_corr(areas: DataFrame, index: DataFrame, metric: str, score: str) -> DataFrame:
    """Correlation of a municipal metric with a development score."""
    joined = areas.join(index, "cod6", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("municipios"),
        F.count(score).alias("com_indice"),
        F.corr(metric, score).alias("correlacao"),
    )


def care_balance(
    ambulatory: DataFrame, adm: DataFrame, population: DataFrame
) -> DataFrame:
    """Municipalities below the mean ambulatory rate and above the mean admission rate."""
    c = F.col
    n = F.count(F.lit(1))
    amb = ambulatory.groupBy("cod6").agg(n.alias("producao"))
    hosp = adm.groupBy("cod6").agg(n.alias("internacoes"))
    rates = (
        population.join(amb, "cod6", "left")
        .join(hosp, "cod6", "left")
        .withColumn("amb_por_mil", cf.guarded_ratio(c("producao"), c("populacao"), 1000))
        .withColumn("int_por_mil", cf.guarded_ratio(c("internacoes"), c("populacao"), 1000))
    )
    return rates.where(
        (c("amb_por_mil") < rates.agg(F.avg("amb_por_mil")).scalar())
        & (c("int_por_mil") > rates.agg(F.avg("int_por_mil")).scalar())
    )


def map_metrics(mortality: DataFrame, population: DataFrame) -> DataFrame:
    """Absolute and per-capita metrics per municipality over all its months."""
    c = F.col
    totals = mortality.groupBy("cod6").agg(
        F.sum("internacoes").alias("internacoes"),
        F.sum("obitos").alias("obitos"),
        F.sum("internacoes_uti").alias("internacoes_uti"),
        cf.money_sum(c("custo_total")).alias("custo_total"),
    )
    out = totals.join(population, "cod6", "left")
    return out.select(
        "*",
        cf.percent(c("obitos"), c("internacoes")).alias("taxa_mortalidade"),
        cf.percent(c("internacoes_uti"), c("internacoes")).alias("pct_uti"),
        cf.guarded_ratio(c("custo_total"), c("internacoes")).alias("custo_medio"),
        cf.guarded_ratio(c("internacoes"), c("populacao"), 1000).alias("internacoes_por_mil"),
        cf.guarded_ratio(c("obitos"), c("populacao"), 1000).alias("obitos_por_mil"),
        cf.guarded_ratio(c("internacoes_uti"), c("populacao"), 100000).alias("uti_por_100mil"),
        cf.guarded_ratio(c("custo_total"), c("populacao")).alias("custo_por_habitante"),
    )
