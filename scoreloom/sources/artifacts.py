"""Report sinks: every artefact is a DataFrame written by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.columns import column
from scoreloom.functions.staging import stage


def _flat(df: DataFrame) -> DataFrame:
    """Text sinks hold no arrays: join them with a pipe sign."""
    return df.select(*[
        F.concat_ws("|", column(c).cast("array<string>")).alias(c) if t.startswith("array") else column(c)
        for c, t in df.dtypes])


def write_csv(df: DataFrame, path: str) -> None:
    """Header and rows, quoted where needed, replacing the target."""
    _flat(df).write.mode("overwrite").option("header", True).csv(path)


def write_json_rows(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def report_lines(df: DataFrame) -> DataFrame:
    """``(section, key, value)`` rows as text lines."""
    return df.select(F.concat_ws("\t", "section", "key", F.coalesce("value", F.lit(""))).alias("value"))


def write_report(df: DataFrame, path: str) -> None:
    report_lines(df).write.mode("overwrite").text(path)


def table_lines(name: str, df: DataFrame) -> DataFrame:
    """A small table as ``(table, row, line)``: each row as JSON and as plain text."""
    cells = [F.concat(F.lit(c + "="), F.coalesce(
        (F.concat_ws("|", column(c).cast("array<string>")) if t.startswith("array")
         else column(c).cast("string")), F.lit(""))) for c, t in df.dtypes]
    return df.select(F.lit(name).alias("table"),
                     F.to_json(F.struct(*[column(c) for c in df.columns])).alias("row"),
                     F.concat_ws(", ", *cells).alias("line"))


def write_report_set(named: dict[str, DataFrame], folder: str, stem: str) -> None:
    """A set of named tables as one JSON and one text artefact, computed once."""
    packed = None
    for name, df in named.items():
        rows = table_lines(name, df)
        packed = rows if packed is None else packed.unionByName(rows)
    packed = stage(packed, "report")
    base = f"{folder.rstrip('/')}/{stem}"
    write_json_rows(packed.select("table", "row"), base + ".json")
    write_report(packed.select(F.col("table").alias("section"), F.lit("").alias("key"),
                               F.col("line").alias("value")), base + ".txt")
