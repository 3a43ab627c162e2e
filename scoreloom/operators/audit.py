"""Audits: predicates over a whole table, reported as rows.

Each audit is one aggregate pass and returns ``(check, observed, expected,
passed)``; :func:`require` turns failed rows into an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.columns import column
from scoreloom.functions.reshape import stack_rows
from scoreloom.roles import FACTOR, NUMERIC


class AuditError(ValueError):
    """A table broke at least one audit rule."""


def _row(check: str, observed: Column, expected: Column, passed: Column) -> dict[str, Column]:
    return {"check": F.lit(check), "observed": observed.cast("bigint"),
            "expected": expected.cast("bigint"), "passed": passed}


def _missing_column(df: DataFrame, check: str) -> DataFrame:
    row = _row(check, F.lit(0), F.lit(1), F.lit(False))
    return stack_rows(df.agg(F.count(F.lit(1))), [row])


def audit_id(df: DataFrame, name: str) -> DataFrame:
    """The id column exists, is unique and is never NULL."""
    if name not in df.columns:
        return _missing_column(df, "id_exists")
    # counts per id collapse on the map side, so one repeated id cannot pile up
    per_id = df.groupBy(column(name).alias("__id")).agg(F.count(F.lit(1)).alias("n"))
    seen = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count("__id").alias("n_distinct"),
        F.coalesce(F.sum(F.when(column("__id").isNull(), column("n"))), F.lit(0)).alias("n_null"))
    rows, distinct, null = (F.col(c) for c in ("n_rows", "n_distinct", "n_null"))
    return stack_rows(seen, [
        _row("id_exists", F.lit(1), F.lit(1), F.lit(True)),
        _row("id_unique", distinct, rows, distinct == rows),
        _row("id_not_null", null, F.lit(0), null == 0)])


def audit_label(df: DataFrame, name: str) -> DataFrame:
    """The label column exists and is never NULL."""
    if name not in df.columns:
        return _missing_column(df, "label_exists")
    seen = df.agg(F.count_if(column(name).isNull()).alias("n_null"))
    return stack_rows(seen, [
        _row("label_exists", F.lit(1), F.lit(1), F.lit(True)),
        _row("label_not_null", F.col("n_null"), F.lit(0), F.col("n_null") == 0)])


def audit_dictionary(rows: DataFrame, header_in_rows: bool = False) -> DataFrame:
    """Dictionary rows ``(variable, type)``: header, two cells, no repeats, known types."""
    extra = column("extra").isNotNull() if "extra" in rows.columns else F.lit(False)
    head = F.coalesce(column("variable") == "variable", F.lit(False)) if header_in_rows else F.lit(False)
    facts = rows.groupBy("variable", head.alias("head")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(extra | column("variable").isNull() | column("type").isNull()).alias("bad_cells"),
        F.count_if(~F.coalesce(column("type"), F.lit("")).isin(NUMERIC, FACTOR)).alias("bad_type"),
        F.count_if((column("type") == "type") & ~extra).alias("titles"))
    body = ~F.col("head")
    seen = facts.agg(
        F.count_if(body & (F.col("n") > 1)).alias("repeated"),
        F.coalesce(F.sum(F.when(body, F.col("bad_cells"))), F.lit(0)).alias("bad_cells"),
        F.coalesce(F.sum(F.when(body, F.col("bad_type"))), F.lit(0)).alias("bad_type"),
        F.coalesce(F.sum(F.when(~body, F.col("titles"))), F.lit(0)).alias("titles"))
    checks = [("dictionary_two_cells", "bad_cells"), ("dictionary_no_repeats", "repeated"),
              ("dictionary_known_types", "bad_type")]
    out = [_row(check, F.col(c), F.lit(0), F.col(c) == 0) for check, c in checks]
    if header_in_rows:
        out.insert(0, _row("dictionary_header", F.col("titles"), F.lit(1), F.col("titles") >= 1))
    return stack_rows(seen, out)


def audit_columns(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Columns that only the table or only the dictionary has: ``(variable, side)``."""
    spark = df.sparkSession
    # column names of the table: metadata, one row per column
    have = spark.createDataFrame([(c,) for c in df.columns], "variable string")
    declared = dictionary.select("variable").distinct()
    return (have.join(declared, "variable", "left_anti").withColumn("side", F.lit("table_only"))
            .unionByName(declared.join(have, "variable", "left_anti")
                         .withColumn("side", F.lit("dictionary_only"))))


def audit_volume(df: DataFrame, id_name: str | None = None, target_name: str | None = None,
                 min_rows: int = 50, min_columns: int = 1) -> DataFrame:
    """Enough rows, and enough columns besides id and target."""
    width = len(df.columns) - sum(n is not None for n in (id_name, target_name))
    seen = df.agg(F.count(F.lit(1)).alias("n"))
    return stack_rows(seen, [
        _row("volume_rows", F.col("n"), F.lit(min_rows), F.col("n") >= min_rows),
        _row("volume_columns", F.lit(width), F.lit(min_columns), F.lit(width >= min_columns))])


def require(*audits: DataFrame) -> None:
    """Raise :class:`AuditError` naming every failed check."""
    failed: Sequence[str] = [
        f"{r['check']} (observed {r['observed']}, expected {r['expected']})"
        for a in audits for r in a.where(~F.col("passed")).collect()]
    if failed:
        raise AuditError("; ".join(failed))
