"""Person-level linkage without a person key.

Groups of records can be large (one facility may hold a third of all rows), so
candidates are never all pairs of a block: agreement is tested between distinct
*key values*, each with its best representative, and the tolerances (a day or a
year either side) become a fixed number of exact lookups.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake import functions as cf
from carelake.functions.codes import recode_sex_to_admissions
from carelake.operators.joins import standard_keys

EXACT_KEYS = ["cnes", "data", "sexo", "idade"]


def link_exact(adm: DataFrame, deaths: DataFrame) -> DataFrame:
    """Admissions that ended in death with the in-hospital deaths of equal facility,
    date, sex and age: every match, one row per pair.

    Equality joins on four columns, NULLs never match. A key with many records on
    both sides yields its full product by definition; link_exact_keys gives the
    same result in factored form, whose size is bounded by the distinct keys.
    """
    left = adm.where(F.col("morte") == 1).select("id_aih", *EXACT_KEYS)
    right = deaths.where(F.col("local_ocorrencia") == "1").select("id_obito", *EXACT_KEYS)
    return left.join(right, EXACT_KEYS)


def link_exact_keys(adm: DataFrame, deaths: DataFrame) -> DataFrame:
    """Matching keys with the number of records on each side and of pairs."""
    left = (
        adm.where(F.col("morte") == 1)
        .groupBy(*EXACT_KEYS)
        .agg(F.count(F.lit(1)).alias("n_aih"), F.min("id_aih").alias("primeira_aih"))
    )
    right = (
        deaths.where(F.col("local_ocorrencia") == "1")
        .groupBy(*EXACT_KEYS)
        .agg(F.count(F.lit(1)).alias("n_obitos"), F.min("id_obito").alias("primeiro_obito"))
    )
    return left.join(right, EXACT_KEYS).withColumn("n_pares", F.col("n_aih") * F.col("n_obitos"))


def delivered_admissions(raw: DataFrame) -> DataFrame:
    """Linkage columns of admissions as delivered: the day of leaving, coded ages, sex 1/3."""
    c = F.col
    return standard_keys(raw, "sih_rd").select(
        c("N_AIH").alias("id_aih"),
        "cnes",
        "munic_res",
        cf.parse_ymd(c("DT_SAIDA")).alias("data"),
        c("SEXO").alias("sexo"),
        cf.decode_admission_age(c("IDADE"), c("COD_IDADE")).alias("idade"),
        cf.to_int(c("MORTE")).alias("morte"),
    )


def delivered_deaths(raw: DataFrame) -> DataFrame:
    """Linkage columns of deaths as delivered: day-first dates, packed ages, and sex 1/2
    recoded to that of the admissions."""
    c = F.col
    return standard_keys(raw, "sim_do").select(
        c("CONTADOR").alias("id_obito"),
        "cnes",
        "munic_res",
        cf.parse_dmy(c("DTOBITO")).alias("data"),
        recode_sex_to_admissions(c("SEXO")).alias("sexo"),
        cf.decode_packed_age(c("IDADE")).alias("idade"),
        c("LOCOCOR").alias("local_ocorrencia"),
    )


def age_in_days(packed: Column) -> Column:
    """Days of a packed age with unit 2; hours and minutes (units 1 and 0) are day 0. NULL
    for anything older or unreadable."""
    unit, value = F.substring(packed, 1, 1), cf.to_int(F.substr(packed, F.lit(2)))
    return F.when(unit == "2", value).when(unit.isin("0", "1") & value.isNotNull(), 0)


def infant_deaths(raw: DataFrame) -> DataFrame:
    """Deaths in the first days in the form of link_scored: `data` is the day of birth that
    the date and the age in days give, `idade` the mother's."""
    c = F.col
    dated = standard_keys(raw, "sim_do").select(
        c("CONTADOR").alias("id_obito"),
        "cnes",
        "munic_res",
        F.date_sub(cf.parse_dmy(c("DTOBITO")), age_in_days(c("IDADE"))).alias("data"),
        cf.to_int(c("IDADEMAE")).alias("idade"),
    )
    return dated.where(c("data").isNotNull())


# Agreement (m) and chance-agreement (u) probabilities behind the default weights;
# the u of day and age is that of a window of three values.
MATCH_PROBABILITIES = {"sexo": (0.95, 0.5), "idade": (0.95, 0.03), "data": (0.97, 3 / 365)}


def weights(probabilities=MATCH_PROBABILITIES) -> dict[str, tuple[float, float]]:
    """(agreement, disagreement) log2 weight per comparator."""
    return {
        name: (math.log2(m / u), math.log2((1 - m) / (1 - u)))
        for name, (m, u) in probabilities.items()
    }


# Births against admissions or deaths: the municipality takes the place of the sex.
BIRTH_PROBABILITIES = {
    "munic_res": (0.9, 0.05),
    "idade": (0.95, 0.08),
    "data": (0.97, 3 / 365),
}


def link_scored(
    adm: DataFrame,
    deaths: DataFrame,
    threshold: float = 6.0,
    day_tolerance: int = 1,
    age_tolerance: int = 1,
    probabilities=MATCH_PROBABILITIES,
) -> DataFrame:
    """The best-scoring admission of every death that has one above the threshold.

    Blocks on facility and year; compares day, age and one column of equality (sex,
    or whatever `probabilities` names besides data and idade). Ties go to the
    nearer day, the nearer age, then the lowest admission id. `n_candidatos`
    counts all admissions above the threshold.

    The threshold must be out of reach for a pair that disagrees on day or age:
    only then do the (2*day+1)*(2*age+1) neighbouring keys hold every candidate.
    """
    w = weights(probabilities)
    (equal,) = set(probabilities) - {"data", "idade"}
    for name in ("data", "idade"):
        best_without = w[name][1] + sum(max(w[o]) for o in w if o != name)
        if best_without >= threshold:
            raise ValueError("threshold admits pairs that disagree on day or age")

    c = F.col
    near_keys = ["cnes", "data", "idade"]
    death_keys = [*near_keys, equal]
    # Distinct admission keys with their representative: ids only matter as the tiebreak.
    left = (
        adm.where(c("cnes").isNotNull() & c("data").isNotNull() & c("idade").isNotNull())
        .groupBy(*death_keys)
        .agg(F.min("id_aih").alias("_aih"), F.count(F.lit(1)).alias("_n"))
    )
    near = _neighbours(deaths.select(*death_keys).distinct(), death_keys, day_tolerance, age_tolerance)

    base = w["data"][0] + w["idade"][0]
    agree, differ = w[equal]
    scored = (
        near.join(left, near_keys)
        .withColumn(
            "_score",
            F.when(c(equal) == c(f"k_{equal}"), F.lit(base + agree)).otherwise(
                F.lit(base + differ)
            ),
        )
        .where(c("_score") >= threshold)
    )
    order = F.struct(
        (-c("_score")).alias("a"),
        F.abs("_dd").alias("b"),
        F.abs("_da").alias("c"),
        c("_aih").alias("d"),
    )
    best = scored.groupBy(*[f"k_{k}" for k in death_keys]).agg(
        F.min(order).alias("_best"), F.sum("_n").alias("n_candidatos")
    )
    on = c(f"o.{equal}").eqNullSafe(c(f"b.k_{equal}"))
    for k in near_keys:
        on = on & (c(f"o.{k}") == c(f"b.k_{k}"))
    return (
        deaths.alias("o")
        .join(best.alias("b"), on)
        .select(
            "o.id_obito",
            c("b._best.d").alias("id_aih"),
            (-c("b._best.a")).alias("score"),
            c("b._best.b").alias("dif_dias"),
            c("b._best.c").alias("dif_idade"),
            "b.n_candidatos",
        )
    )


def _neighbours(keys: DataFrame, names: list[str], days: int, years: int) -> DataFrame:
    """Each key with the admission keys within tolerance, same year of the block."""
    c = F.col
    offsets = F.array(
        *[
            F.struct(F.lit(d).alias("dd"), F.lit(a).alias("da"))
            for d in range(-days, days + 1)
            for a in range(-years, years + 1)
        ]
    )
    return (
        keys.select(*[c(k).alias(f"k_{k}") for k in names], F.explode(offsets).alias("_o"))
        .select(
            *[f"k_{k}" for k in names],
            c("_o.dd").alias("_dd"),
            c("_o.da").alias("_da"),
            c("k_cnes").alias("cnes"),
            F.date_add(c("k_data"), c("_o.dd")).alias("data"),
            (c("k_idade") + c("_o.da")).alias("idade"),
        )
        .where(F.year("data") == F.year("k_data"))
    )


def mutual_best(best_by_death: DataFrame) -> DataFrame:
    """One-to-one version: each admission keeps only its best death."""
    order = F.struct((-F.col("score")).alias("a"), "dif_dias", "dif_idade", "id_obito")
    kept = best_by_death.groupBy("id_aih").agg(F.min(order).alias("_k"))
    return kept.select(
        "id_aih",
        F.col("_k.id_obito").alias("id_obito"),
        (-F.col("_k.a")).alias("score"),
        F.col("_k.dif_dias").alias("dif_dias"),
        F.col("_k.dif_idade").alias("dif_idade"),
    )


def post_discharge(
    adm: DataFrame, deaths: DataFrame, keys: list[str], days: int = 30
) -> DataFrame:
    """Discharges with the earliest death of the same key within `days` of leaving.

    Dates fall in buckets of days+1, so the window of a discharge touches its own
    bucket and the next one. Deaths are folded to distinct dates per key and
    bucket (at most days+1 of them) and offered to both buckets: each discharge
    then reads one short array instead of meeting every death of its key.
    """
    c = F.col
    width = days + 1
    bucket = lambda d: F.floor(F.unix_date(d) / F.lit(width)).cast("bigint")
    dated = deaths.where(c("dt_obito").isNotNull()).groupBy(*keys, "dt_obito").agg(
        F.min("id_obito").alias("id_obito")
    )
    offered = dated.withColumn(
        "_b", F.explode(F.array(bucket(c("dt_obito")), bucket(c("dt_obito")) - 1))
    )
    lists = offered.groupBy(*keys, "_b").agg(
        F.collect_list(F.struct("dt_obito", "id_obito")).alias("_dates")
    )
    alive = adm.where(c("morte") == 0).withColumn("_b", bucket(c("dt_saida")))
    inside = F.filter(
        c("_dates"),
        lambda x: (x["dt_obito"] >= c("dt_saida"))
        & (x["dt_obito"] <= F.date_add(c("dt_saida"), days)),
    )
    return (
        alive.join(lists, [*keys, "_b"])
        .withColumn("_first", F.array_min(inside))
        .where(c("_first").isNotNull())
        .select(
            *adm.columns,
            c("_first.dt_obito").alias("dt_obito"),
            c("_first.id_obito").alias("id_obito"),
            F.datediff(c("_first.dt_obito"), c("dt_saida")).alias("dias_ate_obito"),
        )
    )
