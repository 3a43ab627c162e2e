"""Small helpers that all operators of the subpackage share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its whole name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(taken: Iterable[str], wish: str) -> str:
    """``wish``, or a longer name when the table has one like it (in any case)."""
    lower = {t.lower() for t in taken}
    while wish.lower() in lower:
        wish += "_"
    return wish


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
