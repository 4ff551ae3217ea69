"""Joins between fact tables, registries and reference tables.

Fact rows meet either a table with one row per key or another aggregate, so no
join here multiplies rows. Adaptive execution broadcasts the small side when it
measures small and splits a hot shuffle partition when it does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake import functions as cf
from carelake.operators.windows import latest_per_key
from carelake.schemas import KEY_MAPS


def standard_keys(df: DataFrame, source: str) -> DataFrame:
    """The facility and municipality columns of a source under their common names,
    so that tables of different sources join on cnes, munic_res and munic_mov."""
    names = dict(zip(KEY_MAPS[source], ("cnes", "munic_res", "munic_mov")))
    names.pop(None, None)
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def enrich_latest(facts: DataFrame, registry: DataFrame, columns: list[str]) -> DataFrame:
    """Facts with the newest registry snapshot of their facility."""
    latest = latest_per_key(
        registry.select("cnes", "competencia", *columns),
        ["cnes"],
        [F.col("competencia").desc_nulls_last()],
    ).drop("competencia")
    return facts.join(latest, "cnes", "left")


def enrich_simple(facts: DataFrame, registry: DataFrame, columns: list[str]) -> DataFrame:
    """Facts with registry columns by facility alone.

    One output row per matching registry row: give a single-month registry, or
    use enrich_latest / scd_join, to keep one row per fact.
    """
    return facts.join(registry.select("cnes", *columns), "cnes", "left")


def period_key(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), cf.zero_pad(month, 2))


def scd_join(facts: DataFrame, registry: DataFrame, columns: list[str]) -> DataFrame:
    """Facts with the registry snapshot of their own month."""
    keyed = facts.withColumn("competen", period_key(F.col("ano"), F.col("mes")))
    return keyed.join(registry.select("cnes", "competen", *columns), ["cnes", "competen"], "left")


def one_to_many_rollup(admissions: DataFrame, procedures: DataFrame) -> DataFrame:
    """Each admission with the number and value of its procedures."""
    rolled = procedures.groupBy(F.col("sp_naih").alias("n_aih")).agg(
        F.count("sp_atoprof").alias("n_procedimentos"),
        cf.money_sum(F.col("sp_valato")).alias("valor_sp"),
    )
    return admissions.join(rolled, "n_aih", "left")


def occupancy(adm: DataFrame, beds: DataFrame) -> DataFrame:
    """Bed-days used against 30 days of the public beds, per facility and month."""
    c = F.col
    supply = beds.groupBy("cnes", "competen").agg(
        F.sum("qt_sus").alias("leitos_sus"), F.sum("qt_exist").alias("leitos_total")
    )
    demand = adm.groupBy("cnes", "competen").agg(
        F.countDistinct("n_aih").alias("internacoes"), F.sum("dias_perm").alias("diarias")
    )
    return demand.join(supply, ["cnes", "competen"]).withColumn(
        "taxa_ocup", cf.guarded_ratio(c("diarias"), c("leitos_sus") * 30)
    )


def star_children(
    registry: DataFrame, beds: DataFrame, equipment: DataFrame, accreditations: DataFrame
) -> DataFrame:
    """Facility months with totals of three child tables; open accreditations only."""
    keys = ["cnes", "competen"]
    totals = [
        beds.groupBy(*keys).agg(F.sum("qt_sus").alias("leitos")),
        equipment.groupBy(*keys).agg(F.sum("qt_uso").alias("equips")),
        active_only(accreditations).groupBy(*keys).agg(F.count("sgruphab").alias("habs")),
    ]
    out = registry
    for table in totals:
        out = out.join(table, keys, "left")
    return out


def active_only(accreditations: DataFrame) -> DataFrame:
    """Open-ended accreditations carry the end period 999999."""
    return accreditations.where(F.col("cmpt_fim").cast("int") == 999999)


def current_only(registry: DataFrame) -> DataFrame:
    """Facilities updated in their own reference month; the others have left."""
    return registry.where(F.col("competen") == F.col("dt_atual"))


def composite_indicator(
    population: DataFrame, beds: DataFrame, adm: DataFrame, deaths: DataFrame
) -> DataFrame:
    """Supply, admissions and deaths per municipality and year, with four rates."""
    c = F.col
    keys = ["cod6", "ano"]
    supply = (
        beds.groupBy(c("codufmun").alias("cod6"), "ano", "mes")
        .agg(F.sum("qt_sus").alias("_sus"))
        .groupBy(*keys)
        .agg(F.avg("_sus").alias("leitos_sus_medio"))
    )
    demand = adm.groupBy(c("munic_res").alias("cod6"), "ano").agg(
        F.countDistinct("n_aih").alias("internacoes"), F.sum("morte").alias("obitos_hosp")
    )
    lost = deaths.groupBy(c("munic_res").alias("cod6"), "ano").agg(
        F.count(F.lit(1)).alias("obitos_total")
    )
    joined = population.join(supply, keys, "left").join(demand, keys, "left").join(lost, keys, "left")
    return joined.select(
        "*",
        cf.guarded_ratio(c("leitos_sus_medio"), c("populacao"), 1000).alias("leitos_per_1000"),
        cf.guarded_ratio(c("internacoes"), c("populacao"), 1000).alias("taxa_internacao"),
        cf.guarded_ratio(c("obitos_total"), c("populacao"), 1000).alias("taxa_mortalidade"),
        cf.guarded_ratio(c("obitos_hosp"), c("internacoes")).alias("letalidade_hosp"),
    )


def rate_per_thousand(deaths: DataFrame, population: DataFrame) -> DataFrame:
    c = F.col
    counted = deaths.groupBy(c("munic_res").alias("cod6"), "ano").agg(
        F.count(F.lit(1)).alias("obitos")
    )
    return counted.join(population, ["cod6", "ano"], "left").withColumn(
        "taxa_mort_1000", cf.guarded_ratio(c("obitos"), c("populacao"), 1000)
    )


def postcode_rollup(
    adm: DataFrame, lookup: DataFrame, population: DataFrame, per: int = 1000
) -> DataFrame:
    """Admissions, deaths and cost per neighbourhood, absolute and per capita, via the
    5-digit postcode prefix.

    Rows are folded to prefixes first (at most 100,000 of them), so the lookup
    join and everything after it is small however many admissions there are.
    """
    c = F.col
    by_prefix = adm.groupBy(cf.postcode_prefix(c("cep")).alias("cep_prefix")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("morte").alias("_d"),
        F.sum(c("val_tot").cast("decimal(18,2)")).alias("_v"),
    )
    return (
        by_prefix.join(lookup, "cep_prefix")
        .groupBy("bairro")
        .agg(
            F.sum("_n").alias("internacoes"),
            F.sum("_d").alias("obitos"),
            F.sum("_v").cast("double").alias("custo_total"),
        )
        .withColumn("bairro_norm", cf.accent_key(cf.alias_name(c("bairro"))))
        .join(population, "bairro_norm", "left")
        .select(
            "bairro",
            "internacoes",
            "obitos",
            "custo_total",
            "populacao",
            cf.guarded_ratio(c("internacoes"), c("populacao"), per).alias("internacoes_por_mil"),
            cf.guarded_ratio(c("obitos"), c("populacao"), per).alias("obitos_por_mil"),
            cf.guarded_ratio(c("custo_total"), c("populacao")).alias("custo_por_habitante"),
        )
    )


# --- set operations -------------------------------------------------------


def union_labelled(tables: dict[str, DataFrame], columns: list[str], label: str) -> DataFrame:
    """Like tables stacked on their shared columns, each row named by its origin."""
    out = None
    for name, table in tables.items():
        part = table.select(*columns, F.lit(name.upper()).alias(label))
        out = part if out is None else out.unionByName(part)
    return out


def union_flagged(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """Accepted and rejected admissions; columns of one side only are NULL on the other."""
    return accepted.withColumn("rejeitada", F.lit(0)).unionByName(
        rejected.withColumn("rejeitada", F.lit(1)), allowMissingColumns=True
    )


def series_stitch(
    legacy: DataFrame, current: DataFrame, names: dict[str, str], last_legacy_year: int = 2011
) -> DataFrame:
    """Individual records over both formats: the legacy files up to their last
    year, then the rows of the current format that originate as individual."""
    old = legacy.where(F.col("ano") <= last_legacy_year).select(
        *[F.col(src).alias(dst) for src, dst in names.items()], F.lit("legado").alias("formato")
    )
    new = current.where(
        (F.col("ano") > last_legacy_year) & (F.col("pa_docorig") == "I")
    ).select(*names.values(), F.lit("atual").alias("formato"))
    return old.unionByName(new)
