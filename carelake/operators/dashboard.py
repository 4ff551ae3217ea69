"""Filtered rankings and series over the aggregated tables.

Every reader takes a period [lo, hi]; the tables are partitioned by year, so the
year range is added as a partition filter next to the period filter.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake import functions as cf
from carelake.operators.windows import top_rows


def in_period(df: DataFrame, lo: date, hi: date, prefix: str = "") -> DataFrame:
    c = F.col
    out = df.where(c("competencia").between(F.lit(lo), F.lit(hi)))
    if "ano" in df.columns:
        out = out.where(c("ano").between(lo.year, hi.year))
    return out.where(c("cid3").startswith(prefix.upper())) if prefix else out


def facts_in_period(facts: DataFrame, lo: date, hi: date, prefix: str = "") -> DataFrame:
    """Rows of the months of the period, for aggregates by month that are built for one
    question: a filter above the full outer join of the cascade would not reach its inputs."""
    month = F.col("ano") * 12 + F.col("mes")
    first = lo.year * 12 + lo.month + (lo.day > 1)
    out = facts.where(F.col("ano").between(lo.year, hi.year) & month.between(first, hi.year * 12 + hi.month))
    return out.where(F.col("cid3").startswith(prefix.upper())) if prefix else out


def coverage_summary(cascade: DataFrame, panel: DataFrame, beds: DataFrame) -> DataFrame:
    """One row: period covered and totals of the three tables."""
    left = cascade.agg(
        F.min("competencia").alias("inicio"),
        F.max("competencia").alias("fim"),
        F.countDistinct("cid3").alias("n_cids"),
        F.sum("n_internacoes").alias("total_internacoes"),
        F.sum("n_obitos_totais").alias("total_obitos"),
    )
    # Three one-row results, put side by side as scalar subqueries.
    return left.select(
        "*",
        panel.agg(F.countDistinct("cnes")).scalar().alias("n_hospitais"),
        beds.agg(F.countDistinct("codufmun")).scalar().alias("n_municipios"),
        beds.agg(F.sum("leitos_sus_total")).scalar().alias("soma_leitos"),
    )


def rank_codes(cascade: DataFrame, lo: date, hi: date, prefix: str = "", n: int = 50) -> DataFrame:
    """Diagnosis groups by volume. perm_media is the plain mean of the monthly means."""
    c = F.col
    ranked = (
        in_period(cascade, lo, hi, prefix)
        .groupBy("cid3")
        .agg(
            F.sum("n_internacoes").alias("internacoes"),
            F.sum("n_internacoes_csap").alias("csap"),
            F.sum("n_mortes_hospital_sih").alias("mortes_hospital_sih"),
            F.sum("n_obitos_totais").alias("obitos_sim"),
            cf.guarded_ratio(F.sum("n_mortes_hospital_sih"), F.sum("n_internacoes")).alias(
                "letalidade"
            ),
            F.avg("perm_media").alias("perm_media"),
            cf.money_sum(c("custo_total")).alias("custo_total"),
        )
        .where(c("internacoes") > 0)
    )
    return top_rows(ranked, [c("internacoes").desc(), c("cid3")], n)


def series_by_period(cascade: DataFrame, lo: date, hi: date, prefix: str = "") -> DataFrame:
    return (
        in_period(cascade, lo, hi, prefix)
        .groupBy("competencia")
        .agg(
            F.sum("n_internacoes").alias("internacoes"),
            F.sum("n_obitos_totais").alias("obitos"),
            F.sum("n_internacoes_csap").alias("csap"),
            cf.money_sum(F.col("custo_total")).alias("custo"),
        )
        .orderBy("competencia")
    )


def _panel_metrics():
    c = F.col
    return [
        F.sum("n_internacoes").alias("internacoes"),
        F.sum("n_mortes").alias("mortes"),
        cf.guarded_ratio(F.sum("n_mortes"), F.sum("n_internacoes")).alias("mortalidade"),
        F.avg("perm_media").alias("perm_media"),
        F.avg("uti_pct").alias("uti_pct"),
        cf.money_sum(c("custo_total")).alias("custo_total"),
        F.avg("custo_medio").alias("custo_medio"),
    ]


def rank_hospitals(panel: DataFrame, lo: date, hi: date, prefix: str = "", n: int = 30) -> DataFrame:
    c = F.col
    ranked = (
        in_period(panel, lo, hi, prefix)
        .groupBy("cnes")
        .agg(*_panel_metrics())
        .where(c("internacoes") >= 10)
    )
    return top_rows(ranked, [c("internacoes").desc(), c("cnes")], n)


def hospital_profile(panel: DataFrame, cnes: str, lo: date, hi: date, n: int = 30) -> DataFrame:
    c = F.col
    ranked = (
        in_period(panel, lo, hi)
        .where(c("cnes") == cnes)
        .groupBy("cid3")
        .agg(
            *_panel_metrics(),
            F.avg("idade_media").alias("idade_media"),
            F.sum("n_csap").alias("csap"),
        )
        .where(c("internacoes") >= 5)
    )
    return top_rows(ranked, [c("internacoes").desc(), c("cid3")], n)


# Monthly column -> name of its mean.
_CAPACITY_MEANS = {
    "n_hospitais": "n_hospitais",
    "leitos_sus_total": "leitos_sus",
    "leitos_total": "leitos_total",
    "leitos_uti_sus": "uti_sus",
    "leitos_clinico_sus": "clinico_sus",
    "leitos_cirurgico_sus": "cirurgico_sus",
    "leitos_obstetrico_sus": "obstetrico_sus",
    "leitos_pediatrico_sus": "pediatrico_sus",
}


def mean_capacity(capacity: DataFrame, lo: date, hi: date, n: int = 50) -> DataFrame:
    c = F.col
    means = (
        in_period(capacity, lo, hi)
        .groupBy("codufmun")
        .agg(*[F.avg(src).alias(dst) for src, dst in _CAPACITY_MEANS.items()])
        .where(c("leitos_sus") > 0)
    )
    return top_rows(means, [c("leitos_sus").desc(), c("codufmun")], n)


def pick_lists(df: DataFrame, key: str, n: int, min_count: int = 0) -> DataFrame:
    """Values of `key` by total volume, for a selection list.

    The limit is taken before the NULL key is dropped, as the screens do.
    """
    c = F.col
    totals = df.groupBy(key).agg(F.sum("n_internacoes").alias("n")).where(c("n") >= min_count)
    return top_rows(totals, [c("n").desc(), c(key).asc_nulls_last()], n).where(c(key).isNotNull())
