"""Stored tables: definition, upsert, lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entilake.operators.entities import compact_claims, reduced_map
from entilake.session import cut
from entilake.sources.claims import claim_list

#: Stored tables and their columns (fixed names of the data model).
TABLES = {
    "items": "id BIGINT, rev BIGINT, claims STRING, links STRING, label STRING, aliases STRING, description STRING",
    "properties": "id BIGINT, rev BIGINT, claims STRING, datatype STRING, label STRING, aliases STRING, description STRING",
    "itemrevstats": "id BIGINT, rev BIGINT, day INT, langinfo STRING, propinfo STRING, stat_num INT, stat_ref_num INT, stat_q_num INT, label_num INT, desc_num INT, link_num INT, alias_num INT",
    "proprevstats": "id BIGINT, rev BIGINT, day INT, langinfo STRING, label_num INT, desc_num INT, alias_num INT",
}


def create_tables(spark: SparkSession, database: str) -> None:
    """Create the stored tables where they are missing; those of snapshots are partitioned by day."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, columns in TABLES.items():
        by = " PARTITIONED BY (day)" if name.endswith("revstats") else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{by}")


def drop_tables(spark: SparkSession, database: str) -> None:
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def stored_entities(contents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of items and properties as they are stored: claims in compact form, of labels, aliases and descriptions the
    texts of one language. contents: entity_id, rev, is_item and the parts of an entity as texts."""
    kept = cut(contents.select(F.col("entity_id").alias("id"), "rev", "is_item", "claims", "links", "datatype", *[reduced_map(F.col(c)).alias(c) for c in ("label", "aliases", "description")]))
    claims = compact_claims(kept, ["id", "rev", "is_item", "links", "datatype", "label", "aliases", "description"], "claims", claim_list).withColumnRenamed("compact_claims", "claims")
    claims = claims.withColumn("claims", F.coalesce("claims", F.lit("[]")))
    columns = lambda name: [c.split()[0] for c in TABLES[name].split(", ")]
    return claims.where("is_item").select(columns("items")), claims.where(~F.col("is_item")).select(columns("properties"))


def stored_sizes(rows: DataFrame) -> DataFrame:
    """Characters used by the parts of stored entities."""
    parts = [c for c in ("claims", "aliases", "label", "links", "description") if c in rows.columns]
    return rows.agg(F.count("*").alias("entities"), *[F.coalesce(F.sum(F.length(c)), F.lit(0)).cast("bigint").alias(f"{c}_chars") for c in parts])


def merge_into(spark: SparkSession, folder: str, new: DataFrame, keys: list[str], rev: str = "rev") -> DataFrame:
    """Upsert `new` into the rows under `folder` and store the result there as a new version; returns it. Versions are
    folders by number, written as a whole before they count (their success mark), so a failed run changes nothing. The
    last two are kept."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = [f.getPath().getParent().getName() for f in fs.globStatus(path(f"{folder}/v=*/_SUCCESS")) or []]
    versions = sorted(int(x[2:]) for x in done)
    rows = upsert(spark.read.parquet(f"{folder}/v={versions[-1]}"), new, keys, rev) if versions else upsert(new.limit(0), new, keys, rev)
    number = versions[-1] + 1 if versions else 1
    rows.write.mode("overwrite").parquet(f"{folder}/v={number}")
    for old in versions[:-1]:
        fs.delete(path(f"{folder}/v={old}"), True)
    return spark.read.parquet(f"{folder}/v={number}")


def upsert(stored: DataFrame, new: DataFrame, keys: list[str], rev: str) -> DataFrame:
    """Rows of both, one per key: the highest revision wins as a whole, at a tie the new row. A second run with the same
    rows changes nothing."""
    rest = [c for c in stored.columns if c not in keys and c != rev]
    both = stored.withColumn("_new", F.lit(0)).unionByName(new.select(stored.columns).withColumn("_new", F.lit(1)))
    best = F.max(F.struct(rev, "_new", *rest)).alias("_b")
    return both.groupBy(*keys).agg(best).select(*[k for k in keys], f"_b.{rev}", *[f"_b.{c}" for c in rest]).select(stored.columns)


def stored_revision(keys: DataFrame, stored: DataFrame, key: list[str], rev: str) -> DataFrame:
    """`keys` with the revision stored for each, -1 where there is none."""
    known = stored.groupBy(*key).agg(F.max(rev).alias("_rev"))
    return keys.join(known, key, "left").select(*keys.columns, F.coalesce("_rev", F.lit(-1)).cast("bigint").alias("stored_rev"))
