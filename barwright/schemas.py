"""Declared table schemas, their versions, and the rule for changing them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Prices are rounded to eight digits after the point; one that would become 0 is rejected. Running sums
# have ten digits more before the point.
PRICE = T.DecimalType(28, 8)
PRICE_COLUMNS = ["open", "high", "low", "close"]
BAR_COLUMNS = ["symbol", "dt", *PRICE_COLUMNS, "volume"]
KEY = ["symbol", "dt"]
FEATURE_COLUMNS = ["ma3", "ma5", "ma20", "vol10", "ret1d"]

_PRICE_FIELDS = [T.StructField(name, PRICE) for name in PRICE_COLUMNS]

BARS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("dt", T.DateType()),
    *_PRICE_FIELDS,
    T.StructField("volume", T.LongType()),
])

# ``seq`` orders loads: of two rows with one key, the higher seq is the newer.
BRONZE = T.StructType([
    *BARS.fields,
    T.StructField("source", T.StringType()),
    T.StructField("seq", T.LongType()),
])

SILVER = T.StructType([*BARS.fields, T.StructField("seq", T.LongType())])

GOLD = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("dt", T.DateType()),
    *[T.StructField(name, T.DoubleType()) for name in FEATURE_COLUMNS],
])

# Stored form: bronze lies in one folder per load, silver and gold in one folder per month and bucket
# of symbols. An increment rewrites the buckets of the symbols and months it touches.
PARTS = [T.StructField("ym", T.IntegerType()), T.StructField("bucket", T.IntegerType())]
STORED = {
    "bronze_price_raw": T.StructType([*BRONZE.fields, T.StructField("batch", T.LongType())]),
    "price_silver": T.StructType([*SILVER.fields, *PARTS]),
    "features_gold": T.StructType([*GOLD.fields, *PARTS]),
    "silver_tail": T.StructType([*SILVER.fields, *PARTS[1:]]),
    "gold_latest": T.StructType([*GOLD.fields, *PARTS[1:]]),
}


class SchemaChangeError(ValueError):
    """A schema differs from its predecessor in a way that old readers cannot follow."""


def few_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A few numbers and texts of the driver as a table. No Python task makes it, and what is joined
    with an empty one falls out of the plan."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not rows:
        return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                       for f in schema.fields]).where(F.lit(False))
    text = json.dumps([dict(zip(schema.names, row)) for row in rows])
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), T.ArrayType(schema))))


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return few_rows(spark, [], STORED[name])


def check_compatible(old: T.StructType | str, new: T.StructType) -> list[str]:
    """Names of the added columns; dropped, retyped or newly required columns raise.

    ``old`` may be the JSON text kept from an earlier version.
    """
    if isinstance(old, str):
        old = T.StructType.fromJson(json.loads(old))
    before = {field.name: field for field in old.fields}
    after = {field.name: field for field in new.fields}
    problems = [f"{name} was dropped" for name in before if name not in after]
    for name, field in after.items():
        previous = before.get(name)
        if previous is None:
            if not field.nullable:
                problems.append(f"{name} is new and NOT NULL")
        elif previous.dataType != field.dataType:
            problems.append(f"{name} changed from {previous.dataType.simpleString()} "
                            f"to {field.dataType.simpleString()}")
        elif previous.nullable and not field.nullable:
            problems.append(f"{name} became NOT NULL")
    if problems:
        raise SchemaChangeError("; ".join(problems))
    return [name for name in after if name not in before]
