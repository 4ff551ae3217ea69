"""Table builds over the lake folders: raw -> clean -> aggregated.

    {root}/bronze/{source}   raw text, by uf, ano and mes
    {root}/silver/{source}   typed, by ano (and mes)
    {root}/gold/{table}      aggregated, by ano and mes

Each build returns the rows written; it returns 0 and writes nothing when its
main input does not exist. Optional inputs only change how columns are filled.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators import clean, gold, ml
from carelake.schemas import RAW
from carelake.sources.readers import read_population, read_raw
from carelake.sources.sinks import write_partitioned

log = logging.getLogger("carelake.jobs")

# Source -> (cleaning step, partition columns).
CLEANERS = {
    "sih_rd": (clean.clean_admissions, ["ano", "mes"]),
    "cnes_st": (clean.clean_facilities, ["ano", "mes"]),
    "cnes_lt": (clean.clean_beds, ["ano", "mes"]),
    "sim_do": (clean.clean_deaths, ["ano"]),
}


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def build_clean(spark: SparkSession, root: str, source: str, sample: str | None = None) -> int:
    """Clean one source from its raw folder, or from a single sample file.

    Raw folders are laid out by the period the clean table is partitioned by, so
    the job stays narrow; a sample file is not, so its rows are rebalanced.
    """
    step, keys = CLEANERS[source]
    path = sample or f"{root}/bronze/{source}"
    if _table(spark, path) is None:
        log.warning("no raw input for %s at %s", source, path)
        return 0
    cleaned = step(read_raw(spark, path, RAW[source]))
    return write_partitioned(cleaned, f"{root}/silver/{source}", keys, rebalance=sample is not None)


def _cascade(silver):
    deaths = silver("sim_do")
    return gold.care_cascade(silver("sih_rd"), deaths)


# Table -> (main input, builder over a clean-table reader).
BUILDERS = {
    "continuum_cid_mes": ("sih_rd", _cascade),
    "hospital_panel_cid_mes": (
        "sih_rd",
        lambda silver: gold.hospital_panel(silver("sih_rd"), silver("cnes_st")),
    ),
    "leitos_municipio_mes": ("cnes_lt", lambda silver: gold.bed_capacity(silver("cnes_lt"), silver.population)),
    "mortalidade_municipio_competencia": (
        "sih_rd",
        lambda silver: gold.municipality_mortality(silver("sih_rd")),
    ),
}


class Silver:
    """The clean tables, some of them limited to the rows of a condition."""

    def __init__(self, spark: SparkSession, root: str, population: DataFrame | None, only: dict[str, Column] | None = None):
        self.spark, self.root, self.population, self.only = spark, root, population, only or {}

    def __call__(self, source: str) -> DataFrame | None:
        found = _table(self.spark, f"{self.root}/silver/{source}")
        return found if found is None or source not in self.only else found.where(self.only[source])


def build_gold(
    spark: SparkSession, root: str, table: str, population_csv: str | None = None
) -> int:
    """Build one aggregated table from the clean ones."""
    needs, builder = BUILDERS[table]
    population = read_population(spark, population_csv) if population_csv else None
    silver = Silver(spark, root, population)
    if silver(needs) is None:
        log.warning("no clean %s: skipping %s", needs, table)
        return 0
    return write_partitioned(builder(silver), f"{root}/gold/{table}", ["ano", "mes"])


def build_features(spark: SparkSession, root: str) -> int:
    """The split feature set and its metadata, version v1."""
    adm = Silver(spark, root, None)("sih_rd")
    if adm is None:
        log.warning("no clean sih_rd: skipping features")
        return 0
    features = ml.feature_table(adm, ["n_aih"])
    split = ml.stratified_split(features, F.col("n_aih")).drop("n_aih")
    return ml.write_dataset(split, f"{root}/gold/ml_mortalidade_dataset/v1", f"{root}/silver/sih_rd")["n_total"]


def build_all(spark: SparkSession, root: str, population_csv: str | None = None) -> dict[str, int]:
    rows = {source: build_clean(spark, root, source) for source in CLEANERS}
    rows |= {table: build_gold(spark, root, table, population_csv) for table in BUILDERS}
    rows["ml_mortalidade_dataset"] = build_features(spark, root)
    return rows
