"""Incremental builds: only the months that a delivery touches are built again.

    {root}/ledger/loads     (source, uf, competencia, versao): every load of a raw partition
    {root}/ledger/built     the loads whose effects are in the clean and aggregated tables
    {root}/ledger/origins   which periods the rows of a raw partition fall into

Rows of a raw partition need not carry its own period: late and corrected records fall into
others. `origins` says into which, so a reload finds every clean month it adds to or takes
from, and every raw partition that these months are made of. A refresh that is cut off
leaves its loads pending and is simply run again: each month is replaced whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.plans.jobs import BUILDERS, CLEANERS, Silver
from carelake.schemas import RAW
from carelake.sources.readers import read_population, read_raw
from carelake.sources.sinks import read_or_empty, replace_partition

Month = tuple[int | None, int | None]

LOADS = "source string, uf string, competencia string, versao string"
ORIGINS = "raw_ano int, raw_mes int, ano int, mes int"

#: Aggregated table -> the clean tables whose months it follows, and those read whole.
INPUTS = {
    "continuum_cid_mes": (["sih_rd", "sim_do"], []),
    "hospital_panel_cid_mes": (["sih_rd"], ["cnes_st"]),
    "leitos_municipio_mes": (["cnes_lt"], []),
    "mortalidade_municipio_competencia": (["sih_rd"], []),
}


def load_raw(spark: SparkSession, root: str, df: DataFrame, source: str, uf: str, year: int, month: int, version: str) -> int:
    """Replace one raw partition and note the load; a version says which delivery it was."""
    _, rows = replace_partition(df, f"{root}/bronze", source, uf, year, month)
    noted = spark.createDataFrame([(source, uf, f"{year:04d}-{month:02d}", version)], LOADS)
    noted.coalesce(1).write.mode("append").parquet(f"{root}/ledger/loads")
    return rows


def pending(spark: SparkSession, root: str, source: str) -> DataFrame:
    """Loads of a source that no refresh has taken up yet."""
    loads = read_or_empty(spark, f"{root}/ledger/loads", LOADS).where(F.col("source") == source)
    built = read_or_empty(spark, f"{root}/ledger/built", LOADS)
    return loads.distinct().join(built, ["source", "uf", "competencia", "versao"], "left_anti")


def in_months(months: set[Month], year: str = "ano", month: str = "mes") -> Column:
    """Rows of the given months: plain comparisons, so that a scan skips other partitions."""
    one = lambda name, v: F.col(name).isNull() if v is None else F.col(name) == v
    return reduce(lambda a, b: a | b, [one(year, y) & one(month, m) for y, m in sorted(months, key=str)], F.lit(False))


def _months(df: DataFrame, *names: str) -> set[Month]:
    """Distinct months: a few rows of a few partitions."""
    return {tuple(r) for r in df.select(*names).distinct().collect()}


def _raw(spark: SparkSession, root: str, source: str, months: set[Month]) -> DataFrame:
    """Raw rows of the given partitions."""
    raw = read_raw(spark, f"{root}/bronze/{source}", RAW[source])
    return raw.where(in_months(months)).drop("uf", "ano", "mes")


def _replace(df: DataFrame, path: str, keys: list[str], values: tuple) -> None:
    """Overwrite one partition folder whole, also with nothing."""
    here = "/".join(f"{k}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for k, v in zip(keys, values))
    rows = df.where(reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(keys, values)]))
    rows.drop(*keys).hint("rebalance").write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{here}")


def refresh_clean(spark: SparkSession, root: str, source: str, changed: set[Month]) -> set[Month]:
    """Rebuild the clean months that the changed raw partitions touch, and return them."""
    step, keys = CLEANERS[source]
    origins_path = f"{root}/ledger/origins/{source}"
    known = read_or_empty(spark, origins_path, ORIGINS).select("raw_ano", "raw_mes", "ano", "mes")
    before = {tuple(r) for r in known.collect()}  # a few rows per raw partition
    touched = {(y, m) for a, b, y, m in before if (a, b) in changed}
    after = set()
    for raw_month in sorted(changed):
        found = _months(step(_raw(spark, root, source, {raw_month})), "ano", "mes")
        after |= {(*raw_month, *own) for own in found}
        touched |= found
    origins = {o for o in before if o[:2] not in changed} | after
    width = len(keys)
    parts = {own[:width] for own in touched}
    needed = {o[:2] for o in origins if o[2:][:width] in parts}
    cleaned = step(_raw(spark, root, source, needed))
    for part in sorted(parts, key=str):
        _replace(cleaned, f"{root}/silver/{source}", keys, part)
    # Replaced last: until then the old entries name the months to redo.
    rows = spark.createDataFrame(sorted(origins, key=str), ORIGINS)
    for raw_month in sorted(changed):
        mine = rows.where(in_months({raw_month}, "raw_ano", "raw_mes"))
        mine.drop("raw_ano", "raw_mes").coalesce(1).write.mode("overwrite").parquet(
            f"{origins_path}/raw_ano={raw_month[0]}/raw_mes={raw_month[1]}"
        )
    return touched


def refresh_gold(spark: SparkSession, root: str, table: str, months: set[Month] | None, population_csv: str | None = None) -> int:
    """Rebuild the given months of an aggregated table (None: every month) and return how
    many partitions were replaced."""
    follows, whole = INPUTS[table]
    population = read_population(spark, population_csv) if population_csv else None
    silver = Silver(spark, root, population)
    if silver(follows[0]) is None:
        return 0
    path = f"{root}/gold/{table}"
    if months is None:
        months = set().union(*[_months(silver(s), "ano", "mes") for s in follows if silver(s) is not None])
    if not months:
        return 0
    built = BUILDERS[table][1](Silver(spark, root, population, {s: in_months(months) for s in follows}))
    for month in sorted(months, key=str):
        _replace(built, path, ["ano", "mes"], month)
    return len(months)


def refresh(spark: SparkSession, root: str, population_csv: str | None = None) -> dict[str, int]:
    """Take up every pending load; returns the partitions replaced per table."""
    taken = {source: pending(spark, root, source).collect() for source in CLEANERS}  # loads since the last run
    touched: dict[str, set[Month]] = {}
    for source, loads in taken.items():
        changed = {tuple(map(int, r["competencia"].split("-"))) for r in loads}
        if changed:
            touched[source] = refresh_clean(spark, root, source, changed)
    done = {source: len(months) for source, months in touched.items()}
    for table, (follows, whole) in INPUTS.items():
        if any(s in touched for s in whole):
            done[table] = refresh_gold(spark, root, table, None, population_csv)
        elif any(s in touched for s in follows):
            months = set().union(*[touched.get(s, set()) for s in follows])
            done[table] = refresh_gold(spark, root, table, months, population_csv)
    noted = [tuple(r) for loads in taken.values() for r in loads]
    if noted:
        spark.createDataFrame(noted, LOADS).coalesce(1).write.mode("append").parquet(f"{root}/ledger/built")
    return done
