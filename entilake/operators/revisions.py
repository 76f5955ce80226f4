"""Revisions of pages: filters, duplicates, first blocks, latest states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Titles of items and properties (fixed patterns of the data model).
ITEM_TITLE, PROPERTY_TITLE = r"^Q[0-9]+$", r"^Property:P[0-9]+$"


def entity_pages(df: DataFrame, title: str = "title") -> DataFrame:
    """Rows of item and property pages, with entity (title without namespace), entity_id BIGINT and is_item."""
    t = F.col(title)
    kept = df.where(t.rlike(ITEM_TITLE) | t.rlike(PROPERTY_TITLE))
    entity = F.regexp_replace(t, "^Property:", "")
    return kept.withColumn("entity", entity).withColumn("entity_id", F.substring(entity, 2, 20).try_cast("bigint")).withColumn("is_item", t.rlike(ITEM_TITLE))


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in `order`, NULLs last, by an arg-min that combines before the shuffle. The remaining columns
    break ties, so the result does not depend on the order of rows."""
    rest = [c for c in df.columns if c not in keys]
    ranks = [x.alias(f"_o{i}{j}") for i, o in enumerate(order) for j, x in enumerate((o.isNull(), o))]
    best = F.min(F.struct(*ranks, *rest)).alias("_b")
    return df.groupBy(*keys).agg(best).select(*keys, *[f"_b.{c}" for c in rest])


def with_block_rank(df: DataFrame, entity: str, block: str) -> DataFrame:
    """block_rank: 1 for rows of the entity's newest block (file), 2 for the next, and so on. Blocks are ranked after
    their rows are reduced to one each, so the window never holds all revisions of an entity."""
    blocks = df.select(F.col(entity).alias("_e"), F.col(block).alias("_k")).distinct()
    ranked = blocks.withColumn("block_rank", F.row_number().over(W.partitionBy("_e").orderBy(F.col("_k").desc())))
    return df.join(ranked, F.col(entity).eqNullSafe(F.col("_e")) & F.col(block).eqNullSafe(F.col("_k"))).drop("_e", "_k")


def latest_in_first_block(df: DataFrame, entity: str, block: str, rev: str, has_content: Column) -> DataFrame:
    """Highest revision with content in the newest block of each entity, and nothing for an entity whose newest block has
    none. Two aggregates that combine before the shuffle instead of a window over all revisions of an entity."""
    columns = [c for c in df.columns if c not in (entity, block)]
    by_block = df.groupBy(entity, block).agg(F.max(F.when(has_content, F.struct(rev, *[c for c in columns if c != rev]))).alias("_best"))
    newest = by_block.groupBy(entity).agg(F.max(F.struct(F.col(block), F.col("_best"))).alias("_n"))
    return newest.where(F.col("_n._best").isNotNull()).select(entity, F.col(f"_n.{block}").alias(block), "_n._best.*")


def latest(df: DataFrame, keys: list[str], rev: str) -> DataFrame:
    """Highest revision of each key."""
    rest = [c for c in df.columns if c not in keys and c != rev]
    return df.groupBy(*keys).agg(F.max(F.struct(rev, *rest)).alias("_b")).select(*keys, "_b.*")


def before(df: DataFrame, stamp: str, max_date: str) -> DataFrame:
    """Rows with a time stamp below `max_date`, compared as text; all rows if it is empty."""
    return df.where(F.lit(max_date) > F.col(stamp)) if max_date else df


def union_sources(sources: list[DataFrame], rank: str = "file_rank") -> DataFrame:
    """All sources, the newest first, with their place in that order."""
    ranked = [s.withColumn(rank, F.lit(k)) for k, s in enumerate(sources)]
    out = ranked[0]
    for s in ranked[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def consecutive_groups(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """group_no: number, from 0, of the run of equal `value`s a row is in, within its key and order."""
    w = W.partitionBy(key).orderBy(*order)
    changed = (~F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1)).cast("int")
    return df.withColumn("_changed", changed).withColumn("group_no", F.sum("_changed").over(w.rowsBetween(W.unboundedPreceding, 0)).cast("int")).drop("_changed")
