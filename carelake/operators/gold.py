"""Aggregated tables. Each side is reduced to its output keys before any join,
so a key that holds a large share of the rows is folded map-side first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake import functions as cf
from carelake.operators.windows import latest_per_key

CASCADE_KEYS = ["cid3", "munic_res", "ano", "mes"]


def admissions_by_code(adm: DataFrame) -> DataFrame:
    return (
        adm.where(F.col("cid3").isNotNull() & F.col("munic_res").isNotNull())
        .groupBy(*CASCADE_KEYS)
        .agg(
            F.count(F.lit(1)).alias("n_internacoes"),
            F.sum(cf.flag(F.col("csap_flag"))).alias("n_internacoes_csap"),
            F.sum("morte").alias("n_mortes_hospital"),
            F.avg("dias_perm").alias("perm_media"),
            F.avg("idade_anos").alias("idade_media"),
            cf.money_sum(F.col("val_tot")).alias("custo_total"),
            cf.money_avg(F.col("val_tot")).alias("custo_medio"),
            F.sum("uso_uti").alias("n_uti"),
        )
    )


def deaths_by_code(deaths: DataFrame) -> DataFrame:
    return (
        deaths.where(F.col("cid3").isNotNull() & F.col("munic_res").isNotNull())
        .groupBy(*CASCADE_KEYS)
        .agg(
            F.count(F.lit(1)).alias("n_obitos_totais"),
            F.sum("obito_hospitalar").alias("n_obitos_hospitalares"),
        )
    )


def care_cascade(adm: DataFrame, deaths: DataFrame | None = None) -> DataFrame:
    """Admissions and deaths per diagnosis group, residence and month.

    Without a death table the death counts are 0 and hospital deaths stay as
    counted; with one, hospital deaths are coalesced to 0.
    """
    c = F.col
    sih = admissions_by_code(adm)
    lethality = cf.guarded_ratio(c("n_mortes_hospital"), c("n_internacoes")).alias(
        "letalidade_hospitalar"
    )
    zero = F.lit(0).cast("bigint")
    if deaths is None:
        joined = sih.withColumn("n_obitos_totais", zero).withColumn("n_obitos_hospitalares", zero)
        hospital_deaths = c("n_mortes_hospital")
    else:
        joined = sih.join(deaths_by_code(deaths), CASCADE_KEYS, "full")
        hospital_deaths = F.coalesce(c("n_mortes_hospital"), zero)
    count = lambda name: F.coalesce(c(name), zero).alias(name)
    return joined.select(
        *CASCADE_KEYS,
        cf.period_date(c("ano"), c("mes")).alias("competencia"),
        count("n_internacoes"),
        count("n_internacoes_csap"),
        hospital_deaths.alias("n_mortes_hospital_sih"),
        count("n_obitos_totais"),
        count("n_obitos_hospitalares"),
        "perm_media",
        "idade_media",
        "custo_total",
        "custo_medio",
        count("n_uti"),
        lethality,
    )


FACILITY_ATTRIBUTES = ("codufmun", "tp_unid", "esfera", "clientela")


def _stay_histogram(adm: DataFrame, keys: list[str]) -> DataFrame:
    """Partial sums per group and stay length, with the group's middle stays marked.

    An exact median from a built-in aggregate keeps one map object per group and
    sorts its input to do so. Folded by whole days first, a group has at most one
    row per stay length; a running count over those finds the middle, and the
    grouping that follows reuses the window's partitioning.
    """
    c = F.col
    cells = adm.groupBy(*keys, "dias_perm").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count("dias_perm").alias("_ns"),
        F.sum("morte").alias("_d"),
        F.count("morte").alias("_nd"),
        F.sum("uso_uti").alias("_u"),
        F.count("uso_uti").alias("_nu"),
        F.sum(c("val_tot").cast("decimal(18,2)")).alias("_v"),
        F.count("val_tot").alias("_nv"),
        F.sum("idade_anos").alias("_a"),
        F.count("idade_anos").alias("_na"),
        F.sum(cf.flag(c("csap_flag"))).alias("_c"),
    )
    group = Window.partitionBy(*keys)
    upto = F.sum("_ns").over(group.orderBy("dias_perm"))
    counted = cells.withColumn("_hi", upto).withColumn("_all", F.sum("_ns").over(group))
    holds = lambda rank: (rank >= c("_hi") - c("_ns")) & (rank < c("_hi"))
    return counted.withColumn(
        "_low", F.when(holds(F.floor((c("_all") - 1) / 2)), c("dias_perm"))
    ).withColumn("_high", F.when(holds(F.floor(c("_all") / 2)), c("dias_perm")))


def hospital_panel(adm: DataFrame, facilities: DataFrame | None = None) -> DataFrame:
    """Metrics per hospital, diagnosis group and month.

    The latest facility snapshot has one row per hospital, and every group is of
    one hospital, so the attributes are joined after the aggregation: far fewer
    rows meet the join and the hot hospitals are already folded.
    """
    c = F.col
    keys = ["cnes", "cid3", "ano", "mes"]
    panel = (
        _stay_histogram(adm.where(c("cid3").isNotNull() & c("cnes").isNotNull()), keys)
        .groupBy(*keys)
        .agg(
            F.sum("_n").alias("n_internacoes"),
            F.sum("_d").alias("n_mortes"),
            cf.guarded_ratio(F.sum("_d"), F.sum("_nd")).alias("taxa_mortalidade"),
            cf.guarded_ratio(F.sum(c("dias_perm") * c("_ns")), F.sum("_ns")).alias("perm_media"),
            ((F.max("_low") + F.max("_high")) / 2).alias("perm_mediana"),
            F.sum("_u").alias("n_uti"),
            cf.guarded_ratio(F.sum("_u"), F.sum("_nu")).alias("uti_pct"),
            F.sum("_v").cast("double").alias("custo_total"),
            F.try_divide(F.sum("_v").cast("double"), F.sum("_nv")).alias("custo_medio"),
            cf.guarded_ratio(F.sum("_a"), F.sum("_na")).alias("idade_media"),
            F.sum("_c").alias("n_csap"),
        )
        .withColumn("competencia", cf.period_date(c("ano"), c("mes")))
    )
    renamed = {"codufmun": "codufmun_hosp"}
    if facilities is None:
        # Same columns either way, so readers do not depend on which inputs existed.
        return panel.select(
            "*", *[F.lit(None).cast("string").alias(renamed.get(a, a)) for a in FACILITY_ATTRIBUTES]
        )
    latest = latest_per_key(
        facilities.select("cnes", "competencia", *FACILITY_ATTRIBUTES),
        ["cnes"],
        [c("competencia").desc_nulls_last()],
    ).select("cnes", *[c(a).alias(renamed.get(a, a)) for a in FACILITY_ATTRIBUTES])
    return panel.join(latest, "cnes", "left")


def municipality_mortality(adm: DataFrame, state: str = "43") -> DataFrame:
    """Admissions, deaths and death rate (percent of admissions) by residence and month."""
    c = F.col
    n = F.count(F.lit(1))
    return (
        adm.where(
            c("munic_res").startswith(state) & c("ano").isNotNull() & c("mes").isNotNull()
        )
        .groupBy(c("munic_res").alias("cod6"), "ano", "mes")
        .agg(
            n.alias("internacoes"),
            F.sum("morte").alias("obitos"),
            cf.percent(F.sum("morte"), n).alias("taxa_mortalidade"),
            F.avg("dias_perm").alias("permanencia_media"),
            F.sum("uso_uti").alias("internacoes_uti"),
            cf.money_sum(c("val_tot")).alias("custo_total"),
        )
        .withColumn("competencia", cf.period_date(c("ano"), c("mes")))
    )


# Day-hospital beds count in the totals but have no column of their own.
BED_COLUMNS = ("uti", "clinico", "cirurgico", "obstetrico", "pediatrico", "outros")


def bed_capacity(beds: DataFrame, population: DataFrame | None = None) -> DataFrame:
    """Beds by municipality and month; per-capita columns need the population."""
    c = F.col
    capacity = (
        beds.where(c("codufmun").isNotNull())
        .groupBy("codufmun", "ano", "mes")
        .agg(
            F.countDistinct("cnes").alias("n_hospitais"),
            F.sum("qt_sus").alias("leitos_sus_total"),
            F.sum("qt_exist").alias("leitos_total"),
            *[
                F.sum(F.when(c("categoria") == k, c("qt_sus")).otherwise(0)).alias(
                    f"leitos_{k}_sus"
                )
                for k in BED_COLUMNS
            ],
        )
        .withColumn("competencia", cf.period_date(c("ano"), c("mes")))
    )
    if population is None:
        return capacity.select(
            "*",
            F.lit(None).cast("int").alias("populacao"),
            F.lit(None).cast("double").alias("leitos_sus_por_1000hab"),
            F.lit(None).cast("double").alias("leitos_uti_por_100khab"),
        )
    return per_capita(
        capacity,
        population.select(c("cod6").cast("string").alias("codufmun"), "populacao"),
        ["codufmun"],
        {
            "leitos_sus_por_1000hab": ("leitos_sus_total", 1000),
            "leitos_uti_por_100khab": ("leitos_uti_sus", 100000),
        },
    )


def per_capita(
    df: DataFrame, population: DataFrame, keys: list[str], metrics: dict[str, tuple[str, float]]
) -> DataFrame:
    """Left join to population; each metric is NULL where population is missing or 0.

    No broadcast hint: the planner broadcasts the population while it is small
    and falls back to a shuffle join when it is not.
    """
    joined = df.join(population, keys, "left")
    return joined.select(
        "*",
        *[
            cf.guarded_ratio(F.col(src), F.col("populacao"), scale).alias(name)
            for name, (src, scale) in metrics.items()
        ],
    )
