"""What to load next: periods, ledger, file catalog and its coverage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake import functions as cf
from carelake.operators.windows import top_per_key


def last_period(today: Column, lag_months: int = 2) -> Column:
    """Newest month expected to be published, as its first day."""
    return F.add_months(F.trunc(today, "month"), -lag_months)


def months_between(start: Column, end: Column) -> Column:
    """Array of month starts, both ends included; empty when the end comes first."""
    return F.when(
        start <= end, F.sequence(start, end, F.expr("interval 1 month"))
    ).otherwise(F.array().cast("array<date>"))


def period_range(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row per month of each input row's range."""
    month = F.col("competencia")
    return df.select("*", F.explode(months_between(start, end)).alias("competencia")).select(
        "*", F.year(month).alias("ano"), F.month(month).alias("mes")
    )


def period_text(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def incremental_plan(
    scopes: DataFrame,
    start: Column,
    end: Column,
    ledger: DataFrame | None = None,
    skip_completed: bool = True,
) -> DataFrame:
    """(source, uf, competencia) still to load for the given (source, uf) scopes.

    A backfill passes skip_completed=False; an explicit range passes no ledger.
    """
    wanted = period_range(scopes, start, end).select(
        "source", "uf", period_text(F.col("competencia")).alias("competencia")
    )
    if ledger is None or not skip_completed:
        return wanted
    return wanted.join(ledger, ["source", "uf", "competencia"], "left_anti")


def scopes(spark, sources: list[str], ufs: list[str]) -> DataFrame:
    """All (source, uf) combinations of two configured lists."""
    return spark.range(1).select(
        F.explode(F.array(*[F.lit(s) for s in sources])).alias("source")
    ).select("source", F.explode(F.array(*[F.lit(u) for u in ufs])).alias("uf"))


def ingest_outcomes(attempts: DataFrame) -> DataFrame:
    """ok / empty / failed per (source, uf) from attempts with rows and an error text."""
    c = F.col
    failed = c("erro").isNotNull()
    empty = ~failed & (F.coalesce(c("arquivos"), F.lit(0)) == 0)
    return attempts.groupBy("source", "uf").agg(
        F.count_if(~failed & ~empty).alias("ok"),
        F.count_if(empty).alias("vazias"),
        F.count_if(failed).alias("falhas"),
    )


# Publication rhythm of each dataset, and whether files are per state.
DATASETS = {
    "sih": ("monthly", True),
    "sia": ("monthly", True),
    "cnes": ("monthly", True),
    "sim": ("yearly", True),
    "sinasc": ("yearly", True),
    "sinan": ("yearly", False),
}
_MONTHLY = [d for d, (rhythm, _) in DATASETS.items() if rhythm == "monthly"]
_YEARLY_STATE = [d for d, (rhythm, uf) in DATASETS.items() if rhythm == "yearly" and uf]
_YEARLY_COUNTRY = [d for d, (_, uf) in DATASETS.items() if not uf]


def _century(yy: Column) -> Column:
    return F.when(yy < 80, yy + 2000).otherwise(yy + 1900)


def catalog_parse(listing: DataFrame) -> DataFrame:
    """Type, state, year and month read from file names; other names are left out.

    Names are read from the end, where the widths are fixed:
    {TYPE}{UF}{YY}{MM}, {TYPE}{UF}{YYYY} or {TYPE}BR{YY}, then .parquet.
    """
    c = F.col
    name = F.upper("file_name")
    part = lambda pattern, i: F.regexp_extract(name, pattern, i)
    monthly = r"^(.+?)([A-Z]{2})([0-9]{2})(0[1-9]|1[0-2])\.PARQUET$"
    yearly = r"^(.+?)([A-Z]{2})([0-9]{4})\.PARQUET$"
    country = r"^(.+?)(BR)([0-9]{2})\.PARQUET$"
    pattern = (
        F.when(c("dataset").isin(_MONTHLY), "m")
        .when(c("dataset").isin(_YEARLY_STATE), "y")
        .when(c("dataset").isin(_YEARLY_COUNTRY), "c")
    )
    pick = lambda i: (
        F.when(pattern == "m", part(monthly, i))
        .when(pattern == "y", part(yearly, i))
        .when(pattern == "c", part(country, i))
    )
    number = pick(3).try_cast("int")
    return (
        listing.withColumn("tipo", pick(1))
        .withColumn("uf", pick(2))
        .withColumn("ano", F.when(pattern == "y", number).otherwise(_century(number)))
        .withColumn("mes", F.when(pattern == "m", part(monthly, 4).try_cast("int")))
        .where(c("tipo") != "")
    )


def latest_per_type(entries: DataFrame) -> DataFrame:
    """Newest file of each type; a yearly file counts as December."""
    c = F.col
    order = [
        c("ano").desc(),
        F.coalesce(c("mes"), F.lit(12)).desc(),
        c("file_name").asc(),
    ]
    return top_per_key(entries, ["dataset", "tipo"], order, 1)


def availability_grid(entries: DataFrame, lo: date, hi: date) -> DataFrame:
    """Every observed type against the calendar, 'X' where a file exists."""
    c = F.col
    first, last = F.lit(lo).cast("date"), F.lit(hi).cast("date")
    have = entries.select("dataset", "tipo", "ano", "mes").distinct()
    types = have.select("dataset", "tipo").distinct()
    months = F.transform(
        months_between(first, last),
        lambda d: F.struct(F.year(d).alias("ano"), F.month(d).alias("mes")),
    )
    years = F.transform(
        F.sequence(F.lit(lo.year), F.lit(hi.year)),
        lambda y: F.struct(y.alias("ano"), F.lit(None).cast("int").alias("mes")),
    )
    calendar = F.when(c("dataset").isin(_MONTHLY), months).otherwise(years)
    grid = types.select("dataset", "tipo", F.explode(calendar).alias("_p")).select(
        "dataset", "tipo", "_p.ano", "_p.mes"
    )
    on = (
        (c("g.dataset") == c("h.dataset"))
        & (c("g.tipo") == c("h.tipo"))
        & (c("g.ano") == c("h.ano"))
        & c("g.mes").eqNullSafe(c("h.mes"))
    )
    return grid.alias("g").join(have.alias("h"), on, "left").select(
        "g.dataset",
        "g.tipo",
        "g.ano",
        "g.mes",
        F.when(c("h.tipo").isNotNull(), "X").otherwise("").alias("disponivel"),
    )


def coverage_ratio(grid: DataFrame) -> DataFrame:
    c = F.col
    n = F.count(F.lit(1))
    return grid.groupBy("dataset", "tipo").agg(
        F.count_if(c("disponivel") == "X").alias("presentes"),
        n.alias("esperados"),
        cf.guarded_ratio(F.count_if(c("disponivel") == "X"), n).alias("cobertura"),
    )
