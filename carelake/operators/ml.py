"""Leakage-free feature table and its stratified split."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from carelake import functions as cf
from carelake.operators.selection import BOUND, rows_at_ranks
from carelake.schemas import FEATURES, LEAKY_COLUMNS, TARGET
from carelake.sources.sinks import observed

SEED = 42
FILTERS = {
    "morte": "present",
    "cid_principal": "present and not an external cause (V, W, X, Y)",
    "idade_anos": "between 1 and 120",
}


def feature_table(adm: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The declared features and the target of the usable admissions.

    `keep` carries identifier columns along for the split; they are not features.
    """
    c = F.col
    derived = {
        "meso_res": F.substring(c("munic_res").cast("string"), 1, 4),
        "dow_admissao": cf.dow_sunday0(c("dt_inter")),
    }
    usable = adm.where(
        c(TARGET).isNotNull()
        & c("cid_principal").isNotNull()
        & c("idade_anos").between(1, 120)
        & ~cf.is_external_cause(c("cid_principal"))
    )
    return usable.select(
        *(keep or []),
        *[
            derived.get(name, c(name)).cast(kind).alias(name)
            for name, kind in FEATURES.items()
        ],
        c(TARGET).cast("int").alias(TARGET),
    )


def _allocate(strata: DataFrame, size: str, total: str, out: str) -> DataFrame:
    """Share `total` among strata in proportion to `size`, by largest remainder.

    Whole-number arithmetic throughout; `strata` has one row per class.
    """
    everything = Window.partitionBy()
    c = F.col
    ranked = (
        strata.withColumn("_pool", F.sum(size).over(everything))
        .withColumn("_floor", F.expr(f"({total} * {size}) div _pool"))
        .withColumn("_rest", F.expr(f"({total} * {size}) % _pool"))
        .withColumn("_short", c(total) - F.sum("_floor").over(everything))
        .withColumn(
            "_place", F.row_number().over(everything.orderBy(c("_rest").desc(), c("_stratum")))
        )
    )
    extra = F.when(c("_place") <= c("_short"), 1).otherwise(0)
    return ranked.withColumn(out, c("_floor") + extra).drop(
        "_pool", "_floor", "_rest", "_short", "_place"
    )


def split_sizes(counts: DataFrame) -> DataFrame:
    """70/15/15 sizes per stratum from (_stratum, _n): train takes all but 30% of
    the rows rounded up, test half of the others rounded up, validation the rest."""
    everything = Window.partitionBy()
    c = F.col
    total = (
        counts.withColumn("_all", F.sum("_n").over(everything))
        .withColumn("_train_total", F.expr("_all - (3 * _all + 9) div 10"))
        .withColumn("_val_total", F.expr("(_all - _train_total) div 2"))
    )
    train = _allocate(total, "_n", "_train_total", "n_train").withColumn(
        "_other", c("_n") - c("n_train")
    )
    both = _allocate(train, "_other", "_val_total", "n_val")
    return both.select("_stratum", "_n", "n_train", "n_val")


def stratified_split(
    df: DataFrame, key: Column, stratum: str = TARGET, seed: int = SEED, bound: int = BOUND
) -> DataFrame:
    """Adds `split` (train, val, test), exact in size within every stratum.

    Rows are ordered by the md5 of seed and key, so the split is repeatable and
    independent of partitioning. The order is never materialised: the hash at each cut is
    found by narrowing hash prefixes, at most BOUND rows of a stratum are ever ranked, and
    every row is then labelled by comparing its own hash. The table itself is not
    shuffled. `key` must be unique. Runs a few jobs when called.
    """
    c = F.col
    hashed = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string"))))
    slim = hashed.where(c(stratum).isNotNull()).select(
        c(stratum).alias("_stratum"),
        "_h",
        F.conv(F.substring("_h", 1, 15), 16, 10).cast("bigint").alias("_o"),
        F.lit(1).alias("_n"),
    )

    def cuts(ranged: DataFrame) -> DataFrame:
        sizes = split_sizes(ranged.select("_stratum", c("_total").alias("_n")).distinct())
        both = F.array(
            F.struct(F.lit("train").alias("cut"), (c("n_train") - 1).alias("rank")),
            F.struct(F.lit("val").alias("cut"), (c("n_train") + c("n_val") - 1).alias("rank")),
        )
        return ranged.join(sizes.select("_stratum", both.alias("_want")), "_stratum")

    found = rows_at_ranks(slim, ["_stratum"], cuts, order=["_h"], bound=bound)
    cut_hash = found.groupBy("_stratum").agg(
        F.max(F.when(c("_t.cut") == "train", c("_h"))).alias("_train"),
        F.max(F.when(c("_t.cut") == "val", c("_h"))).alias("_val"),
    )
    # One row per class of the target: the planner checks its size. A class too
    # small for a cut has no row and falls to the later splits.
    labelled = hashed.join(cut_hash.withColumnRenamed("_stratum", stratum), stratum, "left")
    label = (
        F.when(c("_h") <= c("_train"), "train").when(c("_h") <= c("_val"), "val").otherwise("test")
    )
    return labelled.select(*df.columns, label.alias("split"))


def split_stats(split: DataFrame, target: str = TARGET) -> DataFrame:
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.avg(target).alias("target_rate")
    )


def feature_stats(features: DataFrame, keys=("sexo", "faixa_etaria", "ano")) -> DataFrame:
    """Size and target rate for each value of each of `keys`, in one pass."""
    c = F.col
    pairs = [
        F.struct(F.lit(k).alias("grupo"), c(k).cast("string").alias("valor")) for k in keys
    ]
    cells = features.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(TARGET).alias("_d")
    )
    return (
        cells.select("_n", "_d", F.explode(F.array(*pairs)).alias("_p"))
        .groupBy("_p.grupo", "_p.valor")
        .agg(
            F.sum("_n").alias("n"),
            cf.guarded_ratio(F.sum("_d"), F.sum("_n")).alias("target_rate"),
        )
    )


SPLITS = ("train", "val", "test")


def _split_metrics(columns: list[str]) -> list[Column]:
    """Size, target sum and an order-independent row checksum of each split."""
    c = F.col
    row = F.xxhash64(*[c(x) for x in columns]).cast("decimal(38,0)")
    out = []
    for name in SPLITS:
        inside = c("split") == name
        out += [
            F.count_if(inside).alias(f"n_{name}"),
            F.sum(F.when(inside, c(TARGET))).alias(f"d_{name}"),
            F.sum(F.when(inside, row)).cast("string").alias(f"sum_{name}"),
        ]
    return out


def write_dataset(split: DataFrame, path: str, source: str) -> dict:
    """Write the splits under `path` and return the metadata kept beside them.

    The full set is the union of the split partitions of one table. The numbers
    are observed while writing, so nothing is read back.
    """
    seen = Observation()
    columns = [x for x in split.columns if x != "split"]
    split.observe(seen, *_split_metrics(columns)).write.mode("overwrite").partitionBy(
        "split"
    ).option("partitionOverwriteMode", "static").option("compression", "zstd").parquet(f"{path}/data")
    got = observed(seen)
    size = {name: got.get(f"n_{name}") or 0 for name in SPLITS}
    rate = {name: got[f"d_{name}"] / n if n else None for name, n in size.items()}
    meta = {
        "version": "v1",
        "created_at": datetime.now(timezone.utc).isoformat(),
        "source": source,
        "n_total": sum(size.values()),
        **{f"n_{name}": n for name, n in size.items()},
        "target": TARGET,
        "target_rate": rate,
        "features": list(FEATURES),
        "feature_types": FEATURES,
        "excluded_features_leakage": list(LEAKY_COLUMNS),
        "filters_applied": FILTERS,
        "random_state": SEED,
        "split_strategy": "stratified_by_target_70_15_15",
        "checksum": {name: got.get(f"sum_{name}") for name in SPLITS},
    }
    text = json.dumps(meta, ensure_ascii=False)
    split.sparkSession.range(1).select(F.lit(text).alias("value")).write.mode("overwrite").text(
        f"{path}/metadata"
    )
    return meta
