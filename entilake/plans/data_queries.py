"""Queries p1 to p3, p5 and p6: the general data-processing operators on the tables of the domain."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entilake.functions.days import parse_timestamp
from entilake.operators import history, merkle, orphans, wide
from entilake.operators.shred import ROOT, with_parent
from entilake.session import cut, ensure_checkpoint_dir
from entilake.sources.claims import CLAIM_TREE, SNAK_PATHS, claim_labels, claim_nodes, entity_references
from entilake.sources.tables import current_rows, table



def _observations(spark: SparkSession, d: str) -> DataFrame:
    return history.observations(table(spark, d, "itemrevstats", "id", "rev", "wd_day", "stat_num"), "id", "wd_day", "rev", ["stat_num"])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Loaded by the merge, in the two runs of p1_merged_in_batches."""
    return p1_merged_in_batches(spark, d).select("id", "from_day")


def p1_versions(spark: SparkSession, d: str) -> DataFrame:
    """All versions with their periods, in one first load; an open version has no last day."""
    dim = history.merge_versions(None, None, _observations(spark, d), "id", "wd_day", ["stat_num"])
    return dim.select("id", "stat_num", "from_day", "to_day", "is_current")


def p1_merged_in_batches(spark: SparkSession, d: str) -> DataFrame:
    """The same dimension, merged in two runs as the rows were loaded: first those of the first half of the load period,
    then the rest, late ones included."""
    rows = table(spark, d, "itemrevstats", "id", "rev", "wd_day", "stat_num", "loaded_at")
    span = rows.agg(F.min("loaded_at").cast("timestamp").cast("double").alias("a"), F.max("loaded_at").cast("timestamp").cast("double").alias("b")).first()
    middle = ((span["a"] or 0) + (span["b"] or 0)) / 2
    early = F.coalesce(F.col("loaded_at").cast("timestamp").cast("double") <= middle, F.lit(True))
    args = ("id", "wd_day", "rev", ["stat_num"])
    first, second = (cut(history.observations(rows.where(part), *args)) for part in (early, ~early))
    dim = cut(history.merge_versions(None, None, first, "id", "wd_day", ["stat_num"]))
    dim = history.merge_versions(dim, first, second, "id", "wd_day", ["stat_num"])
    return dim.select("id", "stat_num", "from_day", "to_day", "is_current")


def _attributes(spark: SparkSession, d: str) -> list[tuple[int, str]]:
    return wide.attribute_list(current_rows(table(spark, d, "wb_properties", "id", "rev", "datatype"), "id", "rev", "datatype"))


def _main_snaks(spark: SparkSession, d: str, *more: str) -> DataFrame:
    items = current_rows(table(spark, d, "wb_items", "id", "rev", "claims"), "id", "rev", "claims")
    nodes = claim_nodes(items, ["id"], only=["main", *more])
    return nodes.withColumn("claim_no", F.get("dewey", F.lit(0)))


_PAYLOAD = ["value", "entity_id", "amount", "latitude", "longitude", "time", "time_precision"]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    attributes = _attributes(spark, d)
    grid = wide.attribute_grid(_main_snaks(spark, d), "id", "property_id", "claim_no", attributes, _PAYLOAD)
    return wide.misfits(grid, "id", attributes).select("id", "property_id")


def _wide(spark: SparkSession, d: str) -> tuple[DataFrame, list[tuple[int, str]]]:
    attributes = _attributes(spark, d)
    return wide.wide_table(wide.attribute_grid(_main_snaks(spark, d, ROOT), "id", "property_id", "claim_no", attributes, _PAYLOAD), "id", attributes), attributes


def p2_wide(spark: SparkSession, d: str) -> DataFrame:
    """One row per item whose current claims are complete, an empty list too, with a typed column per property: the value
    of its first claim that the column holds."""
    return _wide(spark, d)[0]


def p2_cells(spark: SparkSession, d: str) -> DataFrame:
    """The cells of the wide table that hold a value, one row each, read back from its columns."""
    table_, attributes = _wide(spark, d)
    return wide.long_table(table_, "id", attributes)


def p2_set_apart(spark: SparkSession, d: str) -> DataFrame:
    """The values that are in no cell of the wide table, with the reason (see wide.set_apart)."""
    values = cut(_main_snaks(spark, d).select("id", "claim_no", "property_id", "kind", "vtype", "is_text", "entity_kind", *_PAYLOAD))
    apart = wide.set_apart(values, "id", "property_id", "claim_no", _attributes(spark, d))
    return apart.select("id", "property_id", "claim_no", "datatype", "reason", "kind", "vtype", "value")


def p2_set_apart_places(spark: SparkSession, d: str) -> DataFrame:
    """p2_set_apart without the values."""
    return p2_set_apart(spark, d).drop("value")


def p2_balance(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the wide table, and the main values in its cells and set apart together, which are all there are."""
    table_, attributes = _wide(spark, d)
    table_ = cut(table_)
    values = wide.long_table(table_, "id", attributes).select("id").unionByName(p2_set_apart(spark, d).select("id"))
    return values.agg(F.count("*").alias("n_values")).withColumn("n_items", F.lit(table_.count()).cast("bigint"))


def _item_revisions(spark: SparkSession, d: str, *more: str) -> DataFrame:
    rows = table(spark, d, "revision", "rev_id", "title", *more).where(F.col("title").rlike(r"^Q[0-9]+$"))
    return rows.select(F.substring("title", 2, 20).try_cast("bigint").alias("id"), F.col("rev_id").alias("rev"), *more)


def _store(spark: SparkSession) -> merkle.IncrementalStore:
    return merkle.IncrementalStore(spark, f"{ensure_checkpoint_dir(spark)}/increments-{uuid.uuid4().hex}")


def _changed_items(out: DataFrame) -> DataFrame:
    return out.select(F.col("key").cast("int").alias("id"), F.col("version").alias("rev"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Two runs of a store in the shared folder: the first publishes what is stored, with its tree, as the runs so far left
    it, the failed one too; the second loads that tree, reads all deliveries and publishes its output with the new one."""
    store = _store(spark)
    store.run(table(spark, d, "wb_items", "id", "rev"), "id", "rev")
    return _changed_items(store.run(_item_revisions(spark, d), "id", "rev"))


def p3_since_success(spark: SparkSession, d: str) -> DataFrame:
    """What the run after the last successful one of run_log brings out: that one had read all that was delivered before its
    start, the failed run after it published nothing, and this one reads only what was delivered since."""
    log = table(spark, d, "run_log", "started_at", "run_status")
    start = log.where(F.lower(F.trim("run_status")) == "ok").agg(F.max("started_at")).first()[0]
    revisions_ = _item_revisions(spark, d, "delivered_at")
    before = F.coalesce(F.col("delivered_at") < F.lit(start), F.lit(False)) if start else F.lit(False)
    store = _store(spark)
    store.run(revisions_.where(before), "id", "rev")
    return _changed_items(store.run(revisions_.where(~before), "id", "rev"))


def _labelled_snaks(spark: SparkSession, d: str) -> DataFrame:
    items = current_rows(table(spark, d, "wb_items", "id", "rev", "claims"), "id", "rev", "claims")
    return claim_labels(items, ["id"], only=SNAK_PATHS)


def _places(nodes: DataFrame) -> list:
    at = lambda i: F.get("dewey", F.lit(i))
    path = F.col("path")
    place = F.when(path == "main", "m").when(path == "qualifier", "q").otherwise("r")
    group = F.when(path == "reference_snak", at(2)).otherwise(0)
    snak = F.when(path == "main", 0).when(path == "qualifier", at(2)).otherwise(at(3))
    return [at(0).alias("claim_no"), place.alias("snak_place"), group.alias("group_no"), snak.alias("snak_no")]


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    nodes = _labelled_snaks(spark, d)
    return nodes.select("id", *_places(nodes))


def _label(column: str) -> Column:
    return F.array_join(F.transform(column, lambda x: x.cast("string")), ".")


def _nodes(spark: SparkSession, d: str, *only: str) -> DataFrame:
    items = current_rows(table(spark, d, "wb_items", "id", "rev", "claims"), "id", "rev", "claims")
    return claim_nodes(items, ["id"], only=list(only))


def p5_claims(spark: SparkSession, d: str) -> DataFrame:
    """Table of claims; the parent is the item."""
    nodes = with_parent(_nodes(spark, d, "claim"), CLAIM_TREE, "claim")
    return nodes.select("id", _label("dewey").alias("claim_label"), "guid", "rank")


def p5_references(spark: SparkSession, d: str) -> DataFrame:
    """Table of references with their claim."""
    nodes = with_parent(_nodes(spark, d, "reference"), CLAIM_TREE, "reference")
    return nodes.select("id", _label("dewey").alias("reference_label"), _label("parent_dewey").alias("claim_label"))


def p5_snaks(spark: SparkSession, d: str) -> DataFrame:
    """Table of snaks; the parent of main snaks and qualifiers is a claim, that of others a reference."""
    nodes = _nodes(spark, d, *SNAK_PATHS)
    parent = F.when(F.col("path") == "reference_snak", F.slice("dewey", 1, 3)).otherwise(F.slice("dewey", 1, 1))
    return nodes.withColumn("_parent", parent).select("id", "path", _label("dewey").alias("snak_label"), _label("_parent").alias("parent_label"), "kind", "property_id", "vtype", "value")


def p5_snaks_decoded(spark: SparkSession, d: str) -> DataFrame:
    """The snaks with the parts of their values instead of the values as JSON."""
    nodes = _nodes(spark, d, *SNAK_PATHS)
    parent = F.when(F.col("path") == "reference_snak", F.slice("dewey", 1, 3)).otherwise(F.slice("dewey", 1, 1))
    parts = ["kind", "property_id", "vtype", "entity_kind", "entity_id", "amount", "latitude", "longitude", "time", "time_precision"]
    return nodes.withColumn("_parent", parent).select("id", "path", _label("dewey").alias("snak_label"), _label("_parent").alias("parent_label"), *parts)


def _references(spark: SparkSession, d: str) -> DataFrame:
    """(is_property, src_id, src_rev, target_kind, missing_id, beyond): distinct references of the current claims by a whole
    numeric-id. beyond: the digits of an id that no BIGINT holds, missing_id is NULL then."""
    parts = []
    for name, is_property in (("wb_items", False), ("wb_properties", True)):
        rows = current_rows(table(spark, d, name, "id", "rev", "claims"), "id", "rev", "claims")
        found = entity_references(rows, ["id", "rev"]).where(F.col("entity_id").rlike(r"^\s*\d+\s*$"))
        digits = F.regexp_extract("entity_id", r"^\s*0*(\d+)\s*$", 1)
        number = digits.try_cast("bigint")
        target = [F.lower(F.trim("entity_kind")).alias("target_kind"), number.alias("missing_id"), F.when(number.isNull(), digits).alias("beyond")]
        parts.append(found.select(F.lit(is_property).alias("is_property"), F.col("id").alias("src_id"), F.col("rev").alias("src_rev"), *target).where("target_kind in ('item', 'property')"))
    return parts[0].unionByName(parts[1])


def _existing(spark: SparkSession, d: str) -> DataFrame:
    """(target_kind, missing_id) of the entities that exist: a row in wb_items or wb_properties, and no deletion as the latest
    entry."""
    log = table(spark, d, "deletion_log", "log_id", "entity_id", "log_action", "logged_at")
    last = log.where("entity_id is not null").groupBy("entity_id").agg(F.max(F.struct("logged_at", "log_id", F.lower(F.trim("log_action")).alias("action"))).alias("last"))
    gone = last.where(F.col("last.action") == "delete").select(F.col("entity_id").alias("id"))
    named = lambda df, kind: df.select(F.lit(kind).alias("target_kind"), F.col("id").cast("bigint").alias("missing_id"))
    items = table(spark, d, "wb_items", "id").join(gone, "id", "left_anti")
    return named(items, "item").unionByName(named(table(spark, d, "wb_properties", "id"), "property"))


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references with their places; those to ids beyond BIGINT, which no entity can have, are orphans as they are."""
    references = cut(_references(spark, d))
    found = orphans.find_orphans(references, _existing(spark, d), "target_kind", "missing_id").unionByName(references.where("missing_id is null"))
    source = F.when(F.col("is_property"), "wb_properties").otherwise("wb_items")
    return found.select(source.alias("src_table"), "src_id", "src_rev", "target_kind", "missing_id", "beyond")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Orphans with an id that is a BIGINT; for others see p6_impossible."""
    return _orphans(spark, d).where("missing_id is not null").select("src_table", "src_id", "target_kind", "missing_id").distinct()


def p6_impossible(spark: SparkSession, d: str) -> DataFrame:
    """References to ids beyond BIGINT, with the digits."""
    return _references(spark, d).where("missing_id is null").select(F.when(F.col("is_property"), "wb_properties").otherwise("wb_items").alias("src_table"), "src_id", "target_kind", F.col("beyond").alias("missing_digits")).distinct()


def p6_by_month(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references per table and month of the referring revision: distinct (source, target), `unknown` where the
    revision is not in the table or has no possible time stamp."""
    missing = _orphans(spark, d).distinct()
    stamp = parse_timestamp(F.col("rev_timestamp"))
    delivered = F.col("delivered_at").cast("timestamp_ntz")
    times = table(spark, d, "revision", "rev_id", "rev_timestamp", "delivered_at")
    possible = F.when(stamp <= delivered, stamp)
    months = times.groupBy(F.col("rev_id").alias("src_rev")).agg(F.date_format(F.min(possible), "yyyy-MM").alias("ref_month"))
    joined = missing.withColumn("src_rev", F.col("src_rev").cast("bigint")).join(months, "src_rev", "left")
    keyed = joined.groupBy("src_table", F.coalesce("ref_month", F.lit("unknown")).alias("ref_month"), "target_kind")
    return keyed.agg(F.count("*").alias("n_references"), F.count_distinct(F.coalesce(F.col("missing_id").cast("string"), "beyond")).alias("n_missing"))


def queries() -> dict:
    names = ("p1_found", "p1_versions", "p1_merged_in_batches", "p2_found", "p2_wide", "p2_cells", "p2_set_apart", "p2_set_apart_places", "p2_balance", "p3_found", "p3_since_success", "p5_found", "p5_claims", "p5_references", "p5_snaks", "p5_snaks_decoded", "p6_found", "p6_impossible", "p6_by_month")
    return {n: globals()[n] for n in names}
