import datetime
import decimal
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def column(df, name):
    return [r[name] for r in df.select(name).collect()]


def evaluate(spark, rows, schema, *columns):
    """Values of the given columns over hand-written rows, in row order."""
    df = spark.createDataFrame(rows, schema).coalesce(1)
    return [tuple(r) for r in df.select(*columns).collect()]


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return f"dec {value}"
    return None if value is None else f"{type(value).__name__} {value}"


def table_rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted((tuple(normal(v) for v in r) for r in zip(*columns)), key=repr)
