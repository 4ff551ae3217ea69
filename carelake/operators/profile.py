"""Column profiles from a few passes over the whole table instead of a job per column."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake import functions as cf
from carelake.operators.quantiles import with_quantiles
from carelake.operators.windows import top_per_key
from carelake.session import stored


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _missing(df: DataFrame, name: str) -> Column:
    """NULL, or '' in a text column; other types are not compared with text."""
    c = F.col(name)
    return c.isNull() | (c == "") if _is_text(df, name) else c.isNull()


GROUP = 16_384  # combinations of the columns that are folded together, as estimated
SAMPLE = 5_000  # first rows looked at to choose how to count; no result depends on them


def _value(df: DataFrame, name: str) -> Column:
    """The column, NULL where it is missing."""
    return F.when(~_missing(df, name), F.col(name))


def _first_values(df: DataFrame, columns: list[str]) -> dict[str, set]:
    """The values of each column in a few first rows."""
    rows = df.select(*[_value(df, x).alias(x) for x in columns]).take(SAMPLE)
    return {x: {r[i] for r in rows} - {None} for i, x in enumerate(columns)}


def folding_groups(sizes: dict[str, int], limit: int = GROUP) -> list[list[str]]:
    """Columns dealt into groups whose combinations stay within the limit; a column with
    more values than that is alone."""
    groups: list[list[str]] = []
    room = 0
    for name in sorted(sizes, key=lambda x: (sizes[x], x)):
        need = sizes[name] + 1  # missing is a value
        if groups and need <= room:
            groups[-1].append(name)
        else:
            groups.append([name])
            room = limit
        room //= need
    return groups


def value_table(df: DataFrame, columns: list[str], sizes: dict[str, int] | None = None) -> DataFrame:
    """Every value of every column with its count: (coluna, valor, n); NULL and '' share
    the NULL value.

    Columns with few values are folded together, so rows meet one aggregation per group
    and are unpivoted only afterwards, as combinations. Each column is read once. `sizes`
    says about how many values each column has, by default as a few first rows show; it
    decides the grouping and never the result.
    """
    if sizes is None:
        sizes = {x: len(seen) for x, seen in _first_values(df, columns).items()}
    value = lambda x: _value(df, x).cast("string")
    parts = []
    for group in folding_groups({x: sizes[x] for x in columns}):
        folded = df.select(*[value(x).alias(x) for x in group]).groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
        if len(group) == 1:
            parts.append(folded.select(F.lit(group[0]).alias("coluna"), F.col(group[0]).alias("valor"), F.col("_rows").alias("n")))
            continue
        pairs = F.array(*[F.struct(F.lit(x).alias("coluna"), F.col(x).alias("valor")) for x in group])
        unpivoted = folded.select("_rows", F.explode(pairs).alias("_p"))
        parts.append(unpivoted.groupBy("_p.coluna", "_p.valor").agg(F.sum("_rows").alias("n")))
    return reduce(DataFrame.unionByName, parts)


def completeness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing count and percentage per column: one aggregate, one row, no shuffle of values."""
    columns = columns or df.columns
    total = F.count(F.lit(1))
    wide = df.agg(
        total.alias("_total"), *[F.count_if(_missing(df, name)).alias(name) for name in columns]
    )
    pairs = [F.struct(F.lit(x).alias("coluna"), F.col(x).alias("nulos")) for x in columns]
    return (
        wide.select("_total", F.explode(F.array(*pairs)).alias("_p"))
        .select(
            "_p.coluna",
            "_p.nulos",
            cf.percent(F.col("_p.nulos"), F.col("_total")).alias("pct"),
        )
        .orderBy(F.col("pct").desc(), "coluna")
    )


def cardinality(values: DataFrame) -> DataFrame:
    """Distinct values per column (NULL counts as a value)."""
    return values.groupBy("coluna").agg(F.count(F.lit(1)).alias("distintos"))


def status(missing: Column, distinct: Column, total: Column) -> Column:
    return (
        F.when(missing == total, "100% nula")
        .when(distinct == 1, "constante")
        .when(missing * 2 > total, "maioria nula")
        .when(missing > 0, "parcialmente nula")
        .otherwise("100% preenchida")
    )


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing, distinct, top three values and status of each column, all exact: a column
    of ids has its values shuffled (`frequent_values` and `sketches` avoid that). The table
    of values is written once, when called."""
    columns = columns or df.columns
    c = F.col
    values = stored(df.sparkSession, value_table(df, columns), "values")
    summary = values.groupBy("coluna").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(c("valor").isNull(), c("n")).otherwise(0)).alias("nulos"),
        F.count("valor").alias("distintos"),
    )
    top = top_per_key(
        values, ["coluna"], [c("n").desc(), c("valor").asc_nulls_last()], 3, "posicao"
    )
    best = top.groupBy("coluna").agg(
        *[
            F.max(
                F.when(c("posicao") == i, F.coalesce(c("valor"), F.lit("(vazio)")))
            ).alias(f"top{i}")
            for i in (1, 2, 3)
        ],
        *[F.max(F.when(c("posicao") == i, c("n"))).alias(f"n_top{i}") for i in (1, 2, 3)],
    )
    return summary.join(best, "coluna").withColumn(
        "status", status(c("nulos"), c("distintos"), c("total"))
    )


def column_status(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows, missing values and status of each column, from one aggregate without a shuffle
    of values. `distintos` stops at 2: a column is constant if every value is its first one
    (or, where the first rows have none, if its least value is its greatest)."""
    columns = columns or df.columns
    c = F.col
    seen = {x: next(iter(found), None) for x, found in _first_values(df, columns).items()}

    def varied(x: str) -> Column:
        if seen[x] is None:
            return F.min(_value(df, x)) < F.max(_value(df, x))
        return F.count_if(_value(df, x) != F.lit(seen[x])) > 0

    wide = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(_missing(df, x)).alias(f"m_{x}") for x in columns],
        *[varied(x).alias(f"v_{x}") for x in columns],
    )
    distinct = lambda x: F.when(c(f"v_{x}"), 2).when(c(f"m_{x}") < c("_total"), 1).otherwise(0)
    pairs = [
        F.struct(F.lit(x).alias("coluna"), c(f"m_{x}").alias("nulos"), distinct(x).alias("distintos"))
        for x in columns
    ]
    return wide.select("_total", F.explode(F.array(*pairs)).alias("_p")).select(
        "_p.coluna",
        c("_total").alias("total"),
        "_p.nulos",
        "_p.distintos",
        status(c("_p.nulos"), c("_p.distintos"), c("_total")).alias("status"),
    )


def status_counts(profile: DataFrame) -> DataFrame:
    """How many columns are empty, constant and useful."""
    c = F.col
    empty = c("nulos") == c("total")
    constant = (c("distintos") == 1) & ~empty
    return profile.agg(
        F.count(F.lit(1)).alias("n_colunas"),
        F.count_if(empty).alias("n_100_nulas"),
        F.count_if(constant).alias("n_constantes"),
        F.count_if(~empty & ~constant).alias("n_uteis"),
    )


def value_counts(
    df: DataFrame, columns: list[str], n: int = 10, labels: dict[str, dict | None] | None = None
) -> DataFrame:
    """Most frequent values per column with their share and label."""
    c = F.col
    values = value_table(df, columns)
    totals = values.groupBy("coluna").agg(F.sum("n").alias("_total"))
    top = top_per_key(
        values, ["coluna"], [c("n").desc(), c("valor").asc_nulls_last()], n, "posicao"
    )
    known = {
        f"{col}:{value}": label
        for col, mapping in (labels or {}).items()
        for value, label in (mapping or {}).items()
    }
    label = F.lit("")
    if known:
        pairs = [F.lit(x) for pair in known.items() for x in pair]
        label = F.coalesce(
            F.create_map(*pairs)[F.concat(c("coluna"), F.lit(":"), c("valor"))], F.lit("")
        )
    return top.join(totals, "coluna").select(
        "coluna",
        "posicao",
        F.coalesce(c("valor"), F.lit("(vazio)")).alias("valor"),
        "n",
        cf.percent(c("n"), c("_total")).alias("pct"),
        label.alias("rotulo"),
    )


def high_cardinality(df: DataFrame, columns: list[str], n: int = 10) -> DataFrame:
    """Distinct count and most frequent codes of each column (NULL counts as a value)."""
    c = F.col
    values = value_table(df, columns)
    distinct = values.groupBy("coluna").agg(F.count(F.lit(1)).alias("distintos"))
    top = top_per_key(
        values, ["coluna"], [c("n").desc(), c("valor").asc_nulls_last()], n, "posicao"
    )
    return top.join(distinct, "coluna")


TRACKED = 8_192  # counters of the sketch of one column
FEW = 200  # values in the first rows from which a column gets a sketch
OTHER = "\0other"  # stands for the values that cannot reach the share


def frequent_values(df: DataFrame, columns: list[str], share: float = 0.01) -> DataFrame:
    """Every value that fills at least `share` of a column's rows, with its exact count.

    Two passes, and no shuffle of a column's values however many it has. For columns with
    many values a frequent-items sketch (merged from all tasks, TRACKED counters) is off by
    3.5 rows in TRACKED at most, far below the share, so its candidates hold every value
    wanted; in the second pass all other values are one, and what is left has few values
    and is counted exactly. Missing values ('' or NULL) are a value, NULL.
    """
    if not 0.0025 <= share <= 1:
        raise ValueError("the share must lie between 0.0025 and 1")
    c = F.col
    seen = _first_values(df, columns)
    many = [x for x in columns if len(seen[x]) > FEW]
    text = df.select(*[_value(df, x).cast("string").alias(x) for x in columns])
    k = ceil(1.2 / share) + 1
    candidates = {}
    if many:
        found = text.agg(*[F.expr(f"transform(approx_top_k(`{x}`, {k}, {TRACKED}), i -> i.item)").alias(x) for x in many]).first()
        candidates = {x: [v for v in found[x] or [] if v is not None] for x in many}  # at most k each
    kept = [
        F.when(c(x).isin(candidates[x]) if candidates[x] else F.lit(False), c(x)).when(c(x).isNotNull(), OTHER).alias(x)
        if x in candidates
        else c(x)
        for x in columns
    ]
    sizes = {x: len(candidates[x]) if x in candidates else len(seen[x]) for x in columns}
    counted = stored(df.sparkSession, value_table(text.select(*kept), columns, sizes), "values")
    total = counted.groupBy("coluna").agg(F.sum("n").alias("_total"))
    return (
        counted.join(total, "coluna")
        .where((c("n") >= c("_total") * share) & ~c("valor").eqNullSafe(OTHER))
        .select("coluna", "valor", "n", cf.percent(c("n"), c("_total")).alias("pct"))
    )


def quick_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing and approximately distinct values per column from one aggregate of
    fixed size: for tables whose values are too many to shuffle."""
    columns = columns or df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(_missing(df, x)).alias(f"m_{x}") for x in columns],
        *[F.approx_count_distinct(x).alias(f"d_{x}") for x in columns],
    )
    c = F.col
    pairs = [
        F.struct(
            F.lit(x).alias("coluna"), c(f"m_{x}").alias("nulos"), c(f"d_{x}").alias("distintos")
        )
        for x in columns
    ]
    return wide.select("_total", F.explode(F.array(*pairs)).alias("_p")).select(
        "_p.coluna",
        c("_total").alias("total"),
        "_p.nulos",
        "_p.distintos",
        status(c("_p.nulos"), c("_p.distintos"), c("_total")).alias("status"),
    )


NUMERIC_PROBS = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, zeros, range, exact percentiles, mean and deviation of each column.

    Rows are folded to values first: each distinct value is read as a number once, and the
    moments are weighted sums around the mean. Runs a few jobs when called.
    """
    c = F.col
    values = value_table(df, columns)
    texts = [x for x in columns if _is_text(df, x)]
    number = F.when(c("coluna").isin(texts), cf.to_double(c("valor"))).otherwise(c("valor").try_cast("double")) if texts else c("valor").try_cast("double")
    folded = stored(
        df.sparkSession,
        values.select("coluna", number.alias("v"), "n").groupBy("coluna", "v").agg(F.sum("n").alias("n")),
        "numbers",
    )
    mean = folded.groupBy("coluna").agg((F.sum(c("v") * c("n")) / F.sum(F.when(c("v").isNotNull(), c("n")))).alias("media"))
    apart = c("v") - c("media")
    filled = F.coalesce(F.sum(F.when(c("v").isNotNull(), c("n"))), F.lit(0))
    basic = (
        folded.join(mean, "coluna")
        .groupBy("coluna", "media")
        .agg(
            filled.alias("n_naonulos"),
            F.coalesce(F.sum(F.when(c("v") == 0, c("n"))), F.lit(0)).alias("n_zeros"),
            F.min("v").alias("min"),
            F.max("v").alias("max"),
            F.when(filled > 1, F.sqrt(F.sum(apart * apart * c("n")) / (filled - 1))).alias("std"),
        )
        .select("coluna", "n_naonulos", "n_zeros", "min", "max", "media", "std")
    )
    return with_quantiles(basic, folded, ["coluna"], "v", NUMERIC_PROBS, weight="n")


def date_validity(df: DataFrame, columns: list[str]) -> DataFrame:
    """Valid and invalid YYYYMMDD texts per column, with the range of the valid ones.
    Each distinct text is parsed once."""
    dated = value_table(df, columns).withColumn("d", cf.parse_ymd(F.col("valor")))
    bad = F.coalesce(F.sum(F.when(F.col("d").isNull(), F.col("n"))), F.lit(0))
    return dated.groupBy("coluna").agg(
        (F.sum("n") - bad).alias("validas"),
        bad.alias("invalidas"),
        cf.percent(bad, F.sum("n")).alias("pct_invalidas"),
        F.min("d").alias("min"),
        F.max("d").alias("max"),
    )


def critical_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Filled count and percentage of each required field, or that it is absent."""
    total = F.count(F.lit(1))
    entries = []
    for name in fields:
        present = name in df.columns
        filled = F.count_if(~_missing(df, name)) if present else F.lit(None).cast("bigint")
        entries.append((name, present, filled))
    wide = df.agg(total.alias("_total"), *[f.alias(f"f_{name}") for name, _, f in entries])
    pairs = [
        F.struct(
            F.lit(name).alias("campo"),
            F.lit(present).alias("presente"),
            F.col(f"f_{name}").alias("preenchidos"),
        )
        for name, present, _ in entries
    ]
    return wide.select("_total", F.explode(F.array(*pairs)).alias("_p")).select(
        "_p.campo",
        "_p.presente",
        "_p.preenchidos",
        cf.percent(F.col("_p.preenchidos"), F.col("_total")).alias("pct"),
    )


def total_mismatch(df: DataFrame, total: str, parts: list[str]) -> DataFrame:
    """Rows whose total differs from the sum of its parts, to the cent."""
    cents = lambda x: F.coalesce(F.col(x), F.lit(0.0)).cast("decimal(18,2)")
    summed = cents(parts[0])
    for part in parts[1:]:
        summed = summed + cents(part)
    differs = cents(total) != summed
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("linhas"),
        F.count_if(differs).alias("divergentes"),
        cf.percent(F.count_if(differs), n).alias("pct_divergente"),
        F.sum(F.abs(cents(total) - summed)).cast("double").alias("soma_diferenca"),
    )
