"""Trail conditions: histories, rules of integrity, upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATUSES = ("clear", "overgrown", "partially_blocked", "fully_blocked")


def latest(history: DataFrame, key: str, entry_type: str | None = None) -> DataFrame:
    """The latest entry of each key, ties by id.  One aggregation that combines before its shuffle."""
    rows = history if entry_type is None else history.where(F.col("entry_type") == entry_type)
    others = [c for c in history.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), F.struct("created_at", "id")).alias("e")).select(key, "e.*")


def without_status(trails: DataFrame, history: DataFrame) -> DataFrame:
    return trails.join(history.where("entry_type = 'status'"), "trail_id", "left_anti")


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that stand more than once; a null makes a key different from all others."""
    known = df.dropna(subset=list(keys))
    return known.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def violations(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which a rule is false; unknown passes."""
    return df.where(~F.coalesce(rule, F.lit(True)))


def osm_reference_rule() -> Column:
    return F.col("is_draft") | (F.col("osm_type").isNotNull() & F.col("osm_id").isNotNull())


def osm_type_rule() -> Column:
    return F.col("osm_type").isin("way", "relation")


def target_rule() -> Column:
    return F.col("trail_id").isNotNull() | F.col("location_id").isNotNull()


def author_rule(caller: str) -> Column:
    return F.col("created_by") == caller


def value_rule(kind: Column, value: Column, strict: bool = False) -> Column:
    """Known kinds need known shapes: a status one of the statuses, a comment its text, an image its path.
    A status without the key is unknown, so it passes unless ``strict``."""
    status = F.get_json_object(value, "$.status").isin(*STATUSES)
    if strict:
        status = F.coalesce(status, F.lit(False))
    has = lambda key: F.array_contains(F.json_object_keys(value), key)
    return F.when(kind == "status", status).when(kind == "comment", has("text")).when(kind == "image", has("path")).otherwise(True)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children with a key that no parent has."""
    return child.where(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def cascade(child: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Children left after their parents are deleted."""
    return child.join(gone.select(key), key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Old rows, replaced by new ones of the same keys; of several new ones the one with the highest ``version`` wins."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    others = [c for c in old.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct("_new", "version")).alias("v")).select(*keys, "v.*")


def insert_absent(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    return old.unionByName(new.join(old.select(*keys), list(keys), "left_anti"))


def with_defaults(df: DataFrame, user: str | None = None) -> DataFrame:
    """Missing id, time, author and draft flag.  The id is random: materialise the result before using it twice."""
    defaults = {"id": F.expr("uuid()"), "created_at": F.current_timestamp(), "created_by": F.lit(user) if user else F.current_user(), "is_draft": F.lit(False)}
    return df.withColumns({c: F.coalesce(F.col(c), v.cast(df.schema[c].dataType)) for c, v in defaults.items() if c in df.columns})


def split_locations(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Schema step that moves entry points to a table of locations and keeps them: (locations, history with location_id)."""
    point = F.when(F.col("lon").isNotNull() & F.col("lat").isNotNull(), F.sha2(F.concat_ws(",", "lon", "lat"), 256))
    moved = history.withColumn("location_id", point)
    found = moved.where("location_id is not null").groupBy(F.col("location_id").alias("id"), "lon", "lat").agg(F.min("created_at").alias("created_at"))
    return found, moved.drop("lon", "lat")


def recent_first(history: DataFrame, key: str) -> DataFrame:
    """Adds ``nth``: 1 for a key's latest entry."""
    return history.withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("created_at"), F.desc("id"))))
