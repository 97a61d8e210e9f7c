"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressroom.sources.staging import materialize

__all__ = ["ascii_lower", "free_name", "materialize", "partitions", "read", "words"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters between words: ASCII but for digits and letters (after lower-casing).
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, for a column that lives within an
    operator."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character untouched."""
    return F.translate(c, UPPER, LOWER)


def words(text: Column) -> Column:
    """Words of a whole text: runs outside ``GAP`` after lower-casing A-Z; a
    null or word-less text gives an empty array."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), "")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
