"""Lists of bots and property types from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entilake.functions.dims import canonical_datatype


def read_bots(spark: SparkSession, path: str | None) -> DataFrame:
    """bot_name from a JSON file as the user list of the API gives it (query.allusers[].name); empty without a file."""
    if not path:
        return spark.createDataFrame([], "bot_name string")
    rows = spark.read.schema("query struct<allusers: array<struct<name: string>>>").json(path, multiLine=True)
    return rows.select(F.explode("query.allusers").alias("u")).select(F.col("u.name").alias("bot_name"))


def property_types(observed: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """(property_id, datatype): the types that properties declare, then those of a seed list for all others."""
    rows = observed.select("property_id", "datatype").where("datatype is not null").withColumn("_o", F.lit(0))
    if seed is not None:
        rows = rows.unionByName(seed.select("property_id", "datatype").where("datatype is not null").withColumn("_o", F.lit(1)))
    return rows.groupBy("property_id").agg(F.min(F.struct("_o", "datatype")).alias("_t")).select("property_id", "_t.datatype")


def read_seed_types(spark: SparkSession, path: str | None) -> DataFrame | None:
    """(property_id, datatype) of a CSV file with these columns, read as a seed list; datatypes that are not known are left
    out. None without a file."""
    if not path:
        return None
    rows = spark.read.csv(path, header=True, schema="property_id int, datatype string")
    return rows.select("property_id", canonical_datatype(F.col("datatype")).alias("datatype")).where("property_id is not null and datatype is not null")


def read_max_revision(spark: SparkSession, path: str) -> int | None:
    """The greatest revision id in a site statistics file: text, gzip too, in the first bracket group of an insert as its
    third number. None if there is no such line."""
    numbers = spark.read.text(path).select(F.regexp_extract("value", r"VALUES \(\d+,\d+,(\d+)", 1).try_cast("bigint").alias("n"))
    return numbers.agg(F.max("n")).first()[0]
