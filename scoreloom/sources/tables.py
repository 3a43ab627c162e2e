"""Catalog tables: scan, typing by a declared dictionary, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.columns import column
from scoreloom.roles import FACTOR, NUMERIC


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """All rows and columns of a catalog table; later selects prune the scan."""
    return spark.table(name)


def exact_text(value: Column) -> Column:
    """A number as text without passing through a double: whole numbers keep all of up to 38 digits."""
    number = value.try_cast("double")
    whole = F.when(number == F.rint(number), value.try_cast("decimal(38,0)").cast("string"))
    return F.when(number.isNotNull() & ~F.isnan(number), F.coalesce(whole, value.cast("string")))


def as_declared(df: DataFrame, types: dict[str, str], id_name: str | None = None) -> DataFrame:
    """Keep the declared columns, in dictionary order, cast to their kind.

    Numeric columns become doubles (text that is no number and NaN become NULL),
    factor columns become text. A numeric ``id_name`` becomes text too: a double would make one of
    several large ids.
    """
    present = dict(df.dtypes)
    out = []
    for name, kind in types.items():
        if name not in present:
            raise ValueError(f"column {name} is declared but absent")
        if kind == NUMERIC and name == id_name:
            out.append(exact_text(column(name)).alias(name))
        elif kind == NUMERIC:
            value = column(name).try_cast("double")
            out.append(F.when(~F.isnan(value), value).alias(name))
        elif kind == FACTOR:
            out.append(column(name).cast("string").alias(name))
        else:
            raise ValueError(f"type {kind} of {name} is neither numeric nor factor")
    return df.select(*out)


def export_csv(spark: SparkSession, table: str, path: str) -> None:
    """Write a whole catalog table as CSV with a header, replacing the target."""
    read_table(spark, table).write.mode("overwrite").option("header", True).csv(path)
