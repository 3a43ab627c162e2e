"""Delimited text: declared, headerless and inferred reads, and the dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.functions.columns import column
from scoreloom.operators.audit import audit_dictionary, require
from scoreloom.roles import FACTOR, NUMERIC
from scoreloom.sources.tables import as_declared

# Spellings of a missing cell.
MISSING_SPELLINGS = ("null", "Null", "NULL", "NaN", "nan", "Na", "NA", "N/A",
                     "None", "NONE", "\\N", "", "?")
# Dictionary types whose columns are not imported.
DATE_TYPES = ("date", "Date", "DATE")


def _text_reader(spark: SparkSession, sep: str, header: bool):
    return (spark.read.option("sep", sep).option("header", header)
            .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True))


def _blank_to_null(df: DataFrame, spellings: Sequence[str]) -> DataFrame:
    return df.select(*[
        F.when(~F.trim(column(c)).isin(*spellings), F.trim(column(c))).alias(c)
        for c in df.columns])


def read_declared(spark: SparkSession, path: str, types: dict[str, str], sep: str = ",",
                  header: bool = True, names: Sequence[str] | None = None,
                  missing: Sequence[str] = MISSING_SPELLINGS, id_name: str | None = None) -> DataFrame:
    """Read text cells, turn every missing spelling to NULL, cast as declared.

    With a header the columns are found by name; without one they take ``names``
    (default: dictionary order).
    """
    reader = _text_reader(spark, sep, header)
    if header:
        raw = reader.csv(path)
    else:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in (names or types)])
        raw = reader.schema(schema).csv(path)
    absent = [c for c in types if c not in raw.columns]
    if absent:
        raise ValueError(f"declared columns are absent: {absent}")
    return as_declared(_blank_to_null(raw.select(*[column(c) for c in types]), missing), types, id_name)


def read_inferred(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
                  missing: Sequence[str] = MISSING_SPELLINGS,
                  id_name: str | None = None) -> tuple[DataFrame, dict[str, str]]:
    """Infer the kind of each column: numeric when every present cell is a number.

    One aggregate over the text decides all columns, because Spark's own
    inference knows a single missing spelling only.
    """
    if not header:
        raise ValueError("a header is needed when no types are declared")
    text = _blank_to_null(_text_reader(spark, sep, True).csv(path), missing)
    found = text.agg(*[
        F.count_if(column(c).isNotNull() & column(c).try_cast("double").isNull()).alias("n%d" % i)
        for i, c in enumerate(text.columns)]).first()
    types = {c: NUMERIC if found[i] == 0 else FACTOR for i, c in enumerate(text.columns)}
    return as_declared(text, types, id_name), types


def dictionary_rows(spark: SparkSession, path: str) -> DataFrame:
    """The dictionary file as ``(variable, type, extra)`` text rows, trimmed."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("variable", "type", "extra")])
    raw = _text_reader(spark, ",", False).schema(schema).csv(path)
    return raw.select(*[F.trim(column(c)).alias(c) for c in raw.columns])


def resolve_aliases(rows: DataFrame, numeric_aliases: Sequence[str] = (),
                    factor_aliases: Sequence[str] = ()) -> DataFrame:
    """Map type aliases, matched in lower case, to numeric or factor."""
    kind = column("type")
    low = F.lower(kind)
    resolved = kind
    if factor_aliases:
        resolved = F.when(low.isin(*factor_aliases), F.lit(FACTOR)).otherwise(resolved)
    if numeric_aliases:
        resolved = F.when(low.isin(*numeric_aliases), F.lit(NUMERIC)).otherwise(resolved)
    keep = kind.isin(NUMERIC, FACTOR)
    return rows.withColumn("type", F.when(keep, kind).otherwise(resolved))


def read_dictionary(spark: SparkSession, path: str, numeric_aliases: Sequence[str] = (),
                    factor_aliases: Sequence[str] = ()) -> dict[str, str]:
    """Load, check and resolve a ``variable,type`` dictionary, in file order.

    A dictionary describes columns, so it is metadata-sized.
    """
    # one task reads the file, which keeps the order of its lines
    rows = dictionary_rows(spark, path).coalesce(1).withColumn(
        "__line", F.monotonically_increasing_id())
    kept = resolve_aliases(rows.where(~column("type").isin(*DATE_TYPES) | column("type").isNull()),
                           numeric_aliases, factor_aliases)
    require(audit_dictionary(kept, header_in_rows=True))
    body = kept.where(column("variable") != "variable").orderBy("__line")
    return {r["variable"]: r["type"] for r in body.collect()}
