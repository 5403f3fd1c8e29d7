"""What the text operators share: words, shared storage, column handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.operators.storage import delete_at_exit, materialize, release
from ridgeline.operators.storage import shared_folder as shared_dir

__all__ = ["BROADCAST_ROWS", "GAP", "SPACES", "WORD", "delete_at_exit", "materialize", "only", "release", "shared_dir", "table", "word_count", "words"]

#: The characters that separate words: blank, tab, newline, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: Rows of some keys that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts have none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP, -1))


def word_count(text: Column) -> Column:
    """Number of words, 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns alone (new name = source column), so that further columns of df can't clash."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
