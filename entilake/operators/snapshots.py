"""Content snapshots and the time series made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entilake.functions.days import bucket_end, date_of, date_text, day_date, day_index
from entilake.operators.entities import claim_counts, counts_of, json_map
from entilake.session import cut
from entilake.sources.claims import SNAK_PATHS, claim_labels, claim_nodes
from entilake.sources.dump import entity_contents

#: Measures of a snapshot row (fixed names of the data model), and their names in the time series.
MEASURES = {
    "stat_num": "statements",
    "stat_ref_num": "statements_w_refs",
    "stat_q_num": "statements_w_qualifiers",
    "label_num": "labels",
    "desc_num": "descriptions",
    "link_num": "links",
    "alias_num": "aliases",
}


#: Columns of the report of historic sums, in its order (fixed names of the output), by name in `running_totals`.
SUMS = {
    "date": "date", "total_items": "total items", "changed_items": "changed items", "statements": "statements", "statements_w_refs": "statements w refs",
    "statements_w_qualifiers": "statements w qualifiers", "labels": "labels", "descriptions": "descriptions", "links": "links", "aliases": "aliases",
    "items_with_statements": "items with statements",
}


def latest_per_bucket(df: DataFrame, entity: str, day: str, rev: str) -> DataFrame:
    """Highest revision of each entity in each 14-day bucket; bucket: the bucket's last day."""
    rest = [c for c in df.columns if c not in (entity, rev)]
    with_bucket = df.where(F.col(day).isNotNull()).withColumn("bucket", bucket_end(F.col(day)))
    return with_bucket.groupBy(entity, "bucket").agg(F.max(F.struct(rev, *rest)).alias("_b")).select(entity, "bucket", "_b.*")


def replaced(df: DataFrame, key: str = "id", day: str = "wd_day", rev: str = "rev") -> DataFrame:
    """Snapshot rows as a replacing store keeps them: one per key and day, that of the highest revision, NULL measures
    counting as below any number."""
    rest = [c for c in df.columns if c not in (key, day, rev)]
    return df.where(F.col(key).isNotNull() & F.col(day).isNotNull()).groupBy(key, day).agg(F.max(F.struct(rev, *rest)).alias("_b")).select(key, day, "_b.*")


def period_deltas(rows: DataFrame, key: str = "id", day: str = "wd_day") -> DataFrame:
    """Per day: changed and new entities, and the change of each measure against the entity's row before; a NULL measure
    counts as 0. The window holds the snapshots of one entity, at most one per day."""
    w = W.partitionBy(key).orderBy(day)
    change = lambda c: (F.coalesce(c, F.lit(0)) - F.coalesce(F.lag(F.coalesce(c, F.lit(0))).over(w), F.lit(0))).alias(c)
    some = F.coalesce(F.col("stat_num") > 0, F.lit(False)).cast("int")
    had = (some - F.coalesce(F.lag(some).over(w), F.lit(0))).alias("_some")
    each = rows.select(day, F.lag(F.lit(1)).over(w).isNull().cast("int").alias("_new"), *[change(c) for c in MEASURES], had)
    return each.groupBy(day).agg(F.count("*").alias("changed_items"), F.sum("_new").alias("new_items"), *[F.sum(c).alias(c) for c in MEASURES], F.sum("_some").alias("with_statements"))


def running_totals(deltas: DataFrame, day: str = "wd_day") -> DataFrame:
    """State at the end of each existing day: items, changed items of the day, all measures, items with statements. One
    row per day comes in, so the window over all days is small."""
    w = W.partitionBy(F.lit(0)).orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    total = lambda c, n: F.sum(c).over(w).alias(n)
    return deltas.select(date_text(day_date(F.col(day))).alias("date"), total("new_items", "total_items"), "changed_items", *[total(c, n) for c, n in MEASURES.items()], total("with_statements", "items_with_statements"))


def historic_sums(rows: DataFrame, key: str = "id", day: str = "wd_day") -> DataFrame:
    """The report of historic sums: one row per existing day, with the columns and the order of the report."""
    totals = running_totals(period_deltas(rows, key, day), day)
    return totals.select([F.col(c).alias(n) for c, n in SUMS.items()])


def property_roles(df: DataFrame, keys: list[str], claims: str = "claims") -> DataFrame:
    """keys, property_id, role (m, q or r), n: uses of properties in the claims of each revision."""
    path = F.col("path")
    role = F.when(path == "main", "m").when(path == "qualifier", "q").otherwise("r")
    nodes = claim_nodes(df, keys, claims, only=SNAK_PATHS).where("property_id is not null")
    return nodes.groupBy(*keys, "property_id", role.alias("role")).agg(F.count("*").alias("n"))


def _language_info() -> Column:
    """Languages of labels and descriptions, and the number of aliases by language, as JSON."""
    languages = lambda c: F.array_sort(F.map_keys(json_map(F.col(c))))
    aliases = F.transform_values(json_map(F.col("aliases")), lambda k, v: F.coalesce(F.size(F.try_variant_get(v, "$", "array<variant>")), F.lit(0)))
    return F.to_json(F.struct(languages("label").alias("label"), languages("description").alias("description"), aliases.alias("aliases")))


def content_snapshots(revisions: DataFrame, with_info: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows of itemrevstats and of proprevstats: contents of the newest revision with content of each entity in each
    14-day bucket, with the bucket's last day.

    revisions: entity, entity_id, is_item, rev_id, ts and content, each revision once. with_info fills propinfo (uses of
    properties by role) and the langinfo of items, which are NULL otherwise; the langinfo of properties is always there.
    Revisions without content or with a time stamp that is no date are left out. A page with very many revisions in a
    bucket is one row per task in the shuffle."""
    dated = revisions.where("content <> ''").select("entity", "entity_id", "is_item", "rev_id", "ts", "content", day_index(date_of(F.col("ts"))).alias("_day"))
    latest = latest_per_bucket(dated, "entity", "_day", "rev_id").withColumn("day", F.col("bucket"))
    wide = cut(entity_contents(latest.select("entity", "entity_id", "is_item", "rev_id", "ts", "content", "day"), "day"))
    keys = ["id", "rev", "day"]
    contents = wide.withColumnRenamed("entity_id", "id")
    items, properties = contents.where("is_item"), contents.where(~F.col("is_item"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    claims = claim_counts(claim_labels(items, keys, only=["claim", "reference", "qualifier"]), keys)
    counted = counts_of(items.withColumn("langinfo", _language_info() if with_info else F.lit(None).cast("string")), [*keys, "langinfo"]).join(claims, keys, "left")
    if with_info:
        uses = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.concat(F.lit("P"), F.col("property_id").cast("string")), "n"))))
        roles = property_roles(items, keys).groupBy(*keys, "role").agg(uses.alias("u")).groupBy(*keys).agg(F.to_json(F.struct(*[F.first(F.when(F.col("role") == r, F.col("u")), True).alias(r) for r in "mqr"])).alias("propinfo"))
        counted = counted.join(roles, keys, "left")
    else:
        counted = counted.withColumn("propinfo", F.lit(None).cast("string"))
    of_items = counted.select(*keys, "langinfo", "propinfo", *[zero(c) for c in MEASURES])
    of_properties = counts_of(properties.withColumn("langinfo", _language_info()), [*keys, "langinfo"]).select(*keys, "langinfo", "label_num", "desc_num", "alias_num")
    return of_items, of_properties
