"""Queries on revisions, edits and snapshots, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entilake.functions.days import bucket_end, date_of, date_text, day_date, day_index, parse_timestamp
from entilake.operators import edits, entities, revisions, snapshots, store
from entilake.sources.tables import table

MAX_DATE = "2013-09-01T00:00:00Z"


def _deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries of revisions of items and properties; block is the day of delivery, the table's stand-in for a file."""
    return revisions.entity_pages(table(spark, d, "revision")).withColumn("block", F.to_date("delivered_at"))


def _revisions(spark: SparkSession, d: str) -> DataFrame:
    """Each revision once, as first delivered. What follows from the title and the delivery is made afterwards, so it is
    neither compared nor shuffled."""
    raw = table(spark, d, "revision", "rev_id", "page_id", "title", "rev_timestamp", "user_name", "is_ip", "n_bytes", "delivered_at")
    kept = raw.where(F.col("title").rlike(revisions.ITEM_TITLE) | F.col("title").rlike(revisions.PROPERTY_TITLE))
    return revisions.entity_pages(revisions.first_by(kept, ["rev_id"], [F.col("delivered_at")]))


def _dated(spark: SparkSession, d: str) -> DataFrame:
    """Revisions with the day of their time stamp; stamps that are missing, unreadable or after delivery have none."""
    rows = _revisions(spark, d)
    stamp = parse_timestamp(F.col("rev_timestamp"))
    return rows.withColumn("edit_date", F.when(stamp <= F.col("delivered_at"), date_of(F.col("rev_timestamp"))))


def edits_per_day(spark: SparkSession, d: str) -> DataFrame:
    return edits.edits_per_day(_dated(spark, d), table(spark, d, "bots"), "edit_date")


def edits_per_user(spark: SparkSession, d: str) -> DataFrame:
    return edits.edits_per_user(_revisions(spark, d), table(spark, d, "bots"))


def edit_totals(spark: SparkSession, d: str) -> DataFrame:
    return edits.edit_totals(edits_per_user(spark, d))


def bot_lookup_join(spark: SparkSession, d: str) -> DataFrame:
    flagged = edits.with_bot_flag(_revisions(spark, d), table(spark, d, "bots"))
    return flagged.groupBy("is_bot").agg(F.count("*").alias("n_revisions"), F.count_distinct("user_name").alias("n_users"))


def general_counts(spark: SparkSession, d: str) -> DataFrame:
    """Blocks, entities and revisions of items and properties. Deliveries are first reduced to one row per revision, page and
    block, and then to one per page and block, so no row is multiplied for the different counts."""
    rows = _deliveries(spark, d).groupBy("is_item", "title", "block", "rev_id").agg(F.lit(1).alias("_one"))
    revs = rows.where("rev_id is not null").groupBy("is_item", "rev_id").agg(F.lit(1).alias("_one")).groupBy("is_item").agg(F.count("*").alias("r"))
    blocks = rows.groupBy("is_item", "title", "block").agg(F.lit(1).alias("_one")).groupBy("is_item", "title").agg(F.count("*").alias("b")).groupBy("is_item").agg(F.sum("b").alias("b"), F.count("*").alias("e"))
    both = blocks.join(revs, "is_item")  # two rows each
    n = lambda item, c: F.coalesce(F.sum(F.when(F.col("is_item") == item, F.col(c))), F.lit(0).cast("bigint"))
    return both.agg(n(True, "b").alias("item_blocks"), n(False, "b").alias("property_blocks"), n(True, "e").alias("new_items"), n(False, "e").alias("new_properties"), n(True, "r").alias("item_revisions"), n(False, "r").alias("property_revisions"))


def dump_counters(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries, pages, and deliveries of a revision after its first one with content."""
    rows = table(spark, d, "revision", "rev_id", "title", "n_bytes", "delivered_at")
    per_time = rows.groupBy("rev_id", "delivered_at").agg(F.count("*").alias("n"), F.max(F.coalesce(F.col("n_bytes") > 0, F.lit(False))).alias("filled"))
    w = W.partitionBy("rev_id")
    # A revision has few different delivery times; the first with content is known to all of them in one shuffle.
    first = F.min(F.when(F.col("filled"), F.col("delivered_at"))).over(w)
    again = (F.col("delivered_at") > F.col("_first")) & F.col("rev_id").isNotNull()
    late = per_time.withColumn("_first", first).agg(F.sum("n").alias("revisions"), F.coalesce(F.sum(F.when(again, F.col("n"))), F.lit(0).cast("bigint")).alias("duplicates")).first()
    pages = rows.groupBy("title").agg(F.lit(1).alias("_one")).where("title is not null").agg(F.count("*").alias("pages"))
    return pages.select(F.lit(late["revisions"] or 0).cast("bigint").alias("revisions"), "pages", F.lit(late["duplicates"]).cast("bigint").alias("duplicates"))


def page_classes(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("title")
    kind = F.when(t.rlike(revisions.ITEM_TITLE), "item").when(t.rlike(revisions.PROPERTY_TITLE), "property").otherwise("other")
    return table(spark, d, "revision", "title").groupBy(kind.alias("page_class")).agg(F.count("*").alias("n_rows"), F.count_distinct("title").alias("n_pages"))


def dedup_first_seen(spark: SparkSession, d: str) -> DataFrame:
    return _revisions(spark, d).select("rev_id", "title", F.col("delivered_at").cast("string").alias("first_delivered"))


def new_entities(spark: SparkSession, d: str) -> DataFrame:
    """First block of each entity: the day it is new."""
    return _deliveries(spark, d).groupBy("entity", "is_item").agg(date_text(F.min("block")).alias("first_block"))


def block_ranks(spark: SparkSession, d: str) -> DataFrame:
    ranked = revisions.with_block_rank(_deliveries(spark, d).select("entity", "block", "rev_id"), "entity", "block")
    return ranked.groupBy("entity", "block_rank").agg(F.count("*").alias("n_rows"), F.max("rev_id").alias("max_rev"))


def first_block_latest(spark: SparkSession, d: str) -> DataFrame:
    rows = _deliveries(spark, d).select("entity", "block", "rev_id", "n_bytes")
    found = revisions.latest_in_first_block(rows, "entity", "block", "rev_id", F.coalesce(F.col("n_bytes") > 0, F.lit(False)))
    return found.select("entity", date_text(F.col("block")).alias("block"), "rev_id")


def latest_revision_per_entity(spark: SparkSession, d: str) -> DataFrame:
    rows = _deliveries(spark, d).where("n_bytes > 0").select("entity", "rev_id")
    return revisions.latest(rows, ["entity"], "rev_id").select("entity", "rev_id")


def latest_before_date(spark: SparkSession, d: str) -> DataFrame:
    rows = revisions.before(_deliveries(spark, d), "rev_timestamp", MAX_DATE).select("entity", "rev_id")
    return revisions.latest(rows, ["entity"], "rev_id").select("entity", "rev_id")


def snapshot_per_bucket(spark: SparkSession, d: str) -> DataFrame:
    rows = _dated(spark, d).select("entity", "rev_id", day_index(F.col("edit_date")).alias("day"))
    return snapshots.latest_per_bucket(rows, "entity", "day", "rev_id").select("entity", "bucket", "rev_id")


def day_index_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    days = _dated(spark, d).where("edit_date is not null").select(day_index(F.col("edit_date")).alias("day")).groupBy("day").agg(F.count("*").alias("n_rows"))
    return days.select("day", date_text(day_date(F.col("day"))).alias("date"), bucket_end(F.col("day")).alias("bucket"), "n_rows")


def union_sources(spark: SparkSession, d: str) -> DataFrame:
    """The deliveries of each quarter as sources of their own, the newest first; those without a time are with the oldest."""
    rows = table(spark, d, "revision", "rev_id", "delivered_at")
    bounds = ["2013-10-01", "2013-07-01", "2013-04-01", "2013-01-01"]
    parts, upper = [], None
    for b in [*bounds, None]:
        part = rows.where(F.col("delivered_at") >= b) if b else rows
        parts.append(part.where(F.coalesce(F.col("delivered_at") < upper, F.lit(b is None))) if upper else part)
        upper = b
    return revisions.union_sources(parts).groupBy("file_rank").agg(F.count("*").alias("n_rows"), F.count_distinct("rev_id").alias("n_revisions"))


def _snapshots(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.replaced(table(spark, d, "itemrevstats", "id", "rev", "wd_day", *snapshots.MEASURES))


def period_changes(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.period_deltas(_snapshots(spark, d)).select("wd_day", "changed_items", "new_items")


def period_deltas(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.period_deltas(_snapshots(spark, d))


def historic_running_totals(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.running_totals(snapshots.period_deltas(_snapshots(spark, d)))


def historic_sums(spark: SparkSession, d: str) -> DataFrame:
    """The report of historic sums with its own column names."""
    return snapshots.historic_sums(_snapshots(spark, d))


def term_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Snapshot rows with the counts of terms: the stored contents whose revision has a day, the highest revision of each bucket,
    upserted into those of even revisions."""
    stored = table(spark, d, "wb_items", "id", "rev", "label", "aliases", "description").where("id is not null and rev is not null")
    days = _dated(spark, d).where("edit_date is not null").select(F.col("rev_id").alias("rev"), bucket_end(day_index(F.col("edit_date"))).alias("day"))
    dated = stored.withColumn("rev", F.col("rev").cast("bigint")).join(days, "rev")
    counts = entities.counts_of(dated, ["id", "day", "rev"]).select("id", "day", "rev", "label_num", "desc_num", "alias_num").distinct()
    one = lambda rows: revisions.latest(rows, ["id", "day"], "rev").select("id", "day", "rev", "label_num", "desc_num", "alias_num")
    return store.upsert(one(counts.where("rev % 2 = 0")), one(counts.where("rev % 2 <> 0")), ["id", "day"], "rev")


def snapshot_days(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "itemrevstats", "wd_day").where("wd_day is not null").distinct().orderBy("wd_day")


def previous_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Each snapshot with the day and statement count of the one before it."""
    w = W.partitionBy("id").orderBy("wd_day")
    return _snapshots(spark, d).select("id", "wd_day", "stat_num", F.lag("wd_day").over(w).alias("previous_day"), F.lag("stat_num").over(w).alias("previous_stat_num"))


def replace_snapshots(spark: SparkSession, d: str) -> DataFrame:
    return _snapshots(spark, d).select("id", "wd_day", "rev", *snapshots.MEASURES)


def upsert_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots loaded until the middle of 2013 as the store, all later ones as an upsert."""
    rows = table(spark, d, "itemrevstats", "id", "rev", "wd_day", "stat_num", "loaded_at")
    early = F.coalesce(F.col("loaded_at") < "2013-07-01", F.lit(True))
    one = lambda df: revisions.latest(df.select("id", "wd_day", "rev", "stat_num"), ["id", "wd_day"], "rev").select("id", "rev", "wd_day", "stat_num")
    return store.upsert(one(rows.where(early)), one(rows.where(~early)), ["id", "wd_day"], "rev")


def upsert_entities(spark: SparkSession, d: str) -> DataFrame:
    """Stored items, merged with themselves as new rows: one row per item, the highest revision."""
    rows = table(spark, d, "wb_items")
    merged = store.upsert(rows.where("rev % 2 = 0"), rows.where("rev % 2 <> 0 or rev is null"), ["id"], "rev")
    return merged.select("id", "rev", F.length("claims").alias("claims_length"), F.md5(F.coalesce("label", F.lit(""))).alias("label_md5"))


def stored_revision_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Revision stored for each item that was edited, -1 for none."""
    edited = _deliveries(spark, d).where("is_item").select(F.col("entity_id").alias("id")).distinct()
    return store.stored_revision(edited, table(spark, d, "wb_items", "id", "rev").withColumn("id", F.col("id").cast("bigint")), ["id"], "rev")


_DEL = r"""deliveries AS (SELECT *, replace(title, 'Property:', '') AS entity, regexp_full_match(title, 'Q[0-9]+') AS is_item, CAST(delivered_at AS DATE) AS block
 FROM revision WHERE regexp_full_match(title, 'Q[0-9]+') OR regexp_full_match(title, 'Property:P[0-9]+'))"""
_REV = _DEL + r""", revs AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY rev_id ORDER BY delivered_at NULLS LAST, page_id NULLS FIRST, title, rev_timestamp NULLS FIRST, user_name NULLS FIRST, is_ip NULLS FIRST, n_bytes NULLS FIRST) AS k FROM deliveries) WHERE k = 1)"""
_DATED = _REV + r""", dated AS (SELECT *, CASE WHEN regexp_full_match(rev_timestamp, '\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(Z|\+00:00)?')
 AND try_cast(replace(substr(rev_timestamp, 1, 19), 'T', ' ') AS TIMESTAMP) <= delivered_at THEN try_cast(substr(rev_timestamp, 1, 10) AS DATE) END AS edit_date FROM revs)"""
_BOT = "names AS (SELECT DISTINCT bot_name FROM bots WHERE bot_name IS NOT NULL)"
_USERS = f"""{_REV}, {_BOT}, per AS (SELECT coalesce(user_name, '') AS u, coalesce(is_ip, false) AS is_ip, count(*) AS edits FROM revs GROUP BY ALL),
 users AS (SELECT replace(u, ',', '<comma>') AS "user", CASE WHEN is_ip THEN 'yes' ELSE 'no' END AS ip, CASE WHEN u IN (SELECT bot_name FROM names) THEN 'yes' ELSE 'no' END AS bot, edits FROM per)"""
_MEASURES = ", ".join(snapshots.MEASURES)
_SNAP = f"""snaps AS (SELECT id, wd_day, rev, {_MEASURES} FROM (SELECT *, row_number() OVER (PARTITION BY id, wd_day ORDER BY rev DESC, {", ".join(f"{m} DESC NULLS LAST" for m in snapshots.MEASURES)}) AS k
 FROM itemrevstats WHERE id IS NOT NULL AND wd_day IS NOT NULL) WHERE k = 1)"""
_DELTA = f"""{_SNAP}, steps AS (SELECT wd_day, CASE WHEN lag(1) OVER w IS NULL THEN 1 ELSE 0 END AS fresh,
 {", ".join(f"coalesce({m}, 0) - coalesce(lag(coalesce({m}, 0)) OVER w, 0) AS {m}" for m in snapshots.MEASURES)},
 CAST(coalesce(stat_num, 0) > 0 AS INT) - coalesce(lag(CAST(coalesce(stat_num, 0) > 0 AS INT)) OVER w, 0) AS has_some FROM snaps WINDOW w AS (PARTITION BY id ORDER BY wd_day)),
 deltas AS (SELECT wd_day, count(*) AS changed_items, CAST(sum(fresh) AS BIGINT) AS new_items, {", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in snapshots.MEASURES)}, CAST(sum(has_some) AS BIGINT) AS with_statements FROM steps GROUP BY wd_day)"""


def _size(c: str) -> str:
    return f"CASE WHEN json_valid({c}) AND json_type({c}) = 'OBJECT' THEN CAST(len(json_keys({c})) AS INT) ELSE 0 END"


_ALIASES = "CASE WHEN json_valid(aliases) AND json_type(aliases) = 'OBJECT' THEN CAST(coalesce(list_sum(list_transform(json_extract(aliases, '$.*'), lambda x: len(json_extract(x, '$[*]')))), 0) AS INT) ELSE 0 END"


def oracle_sql() -> dict[str, str]:
    day = "CAST(date_diff('day', DATE '2012-01-01', edit_date) AS INT)"
    run = lambda c, n: f"CAST(sum({c}) OVER (ORDER BY wd_day) AS BIGINT) AS {n}"
    return {
        "edits_per_day": f"""WITH {_DATED}, {_BOT}, c AS (SELECT {day} AS i, count(*) FILTER (NOT coalesce(is_ip, false) AND coalesce(user_name IN (SELECT bot_name FROM names), false)) AS bots,
 count(*) FILTER (NOT coalesce(is_ip, false) AND NOT coalesce(user_name IN (SELECT bot_name FROM names), false)) AS humans, count(*) FILTER (coalesce(is_ip, false)) AS anons FROM dated WHERE edit_date IS NOT NULL GROUP BY 1),
 s AS (SELECT CAST(unnest(range(min(i), max(i) + 1)) AS INT) AS i FROM c)
 SELECT i AS "index", strftime(DATE '2012-01-01' + i, '%Y-%m-%d') AS date, coalesce(bots, 0) AS bots, coalesce(humans, 0) AS humans, coalesce(anons, 0) AS anons, coalesce(bots, 0) + coalesce(humans, 0) + coalesce(anons, 0) AS total FROM s LEFT JOIN c USING (i)""",
        "edits_per_user": f'WITH {_USERS} SELECT "user", ip, bot, edits FROM users',
        "edit_totals": f"WITH {_USERS} SELECT CAST(coalesce(sum(edits) FILTER (ip = 'no' AND bot = 'yes'), 0) AS BIGINT) AS bots, CAST(coalesce(sum(edits) FILTER (ip = 'no' AND bot = 'no'), 0) AS BIGINT) AS humans, CAST(coalesce(sum(edits) FILTER (ip = 'yes'), 0) AS BIGINT) AS anons, CAST(coalesce(sum(edits), 0) AS BIGINT) AS total, count(*) AS accounts FROM users",
        "bot_lookup_join": f"WITH {_REV}, {_BOT} SELECT coalesce(user_name IN (SELECT bot_name FROM names), false) AS is_bot, count(*) AS n_revisions, count(DISTINCT user_name) AS n_users FROM revs GROUP BY 1",
        "general_counts": f"WITH {_DEL} SELECT count(DISTINCT (title, block)) FILTER (is_item) AS item_blocks, count(DISTINCT (title, block)) FILTER (NOT is_item) AS property_blocks, count(DISTINCT title) FILTER (is_item) AS new_items, count(DISTINCT title) FILTER (NOT is_item) AS new_properties, count(DISTINCT rev_id) FILTER (is_item) AS item_revisions, count(DISTINCT rev_id) FILTER (NOT is_item) AS property_revisions FROM deliveries",
        "dump_counters": "WITH p AS (SELECT rev_id, min(delivered_at) FILTER (n_bytes > 0) AS f FROM revision GROUP BY 1) SELECT (SELECT count(*) FROM revision) AS revisions, (SELECT count(DISTINCT title) FROM revision) AS pages, (SELECT count(*) FROM revision JOIN p USING (rev_id) WHERE delivered_at > f) AS duplicates",
        "page_classes": "SELECT CASE WHEN regexp_full_match(title, 'Q[0-9]+') THEN 'item' WHEN regexp_full_match(title, 'Property:P[0-9]+') THEN 'property' ELSE 'other' END AS page_class, count(*) AS n_rows, count(DISTINCT title) AS n_pages FROM revision GROUP BY 1",
        "dedup_first_seen": f"WITH {_REV} SELECT rev_id, title, CAST(delivered_at AS VARCHAR) AS first_delivered FROM revs",
        "new_entities": f"WITH {_DEL} SELECT entity, is_item, strftime(min(block), '%Y-%m-%d') AS first_block FROM deliveries GROUP BY ALL",
        "block_ranks": f"WITH {_DEL}, r AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY entity ORDER BY block DESC) AS INT) AS block_rank FROM deliveries) SELECT entity, block_rank, count(*) AS n_rows, max(rev_id) AS max_rev FROM r GROUP BY ALL",
        "first_block_latest": f"WITH {_DEL}, m AS (SELECT entity, max(block) AS block FROM deliveries GROUP BY 1) SELECT entity, strftime(block, '%Y-%m-%d') AS block, max(rev_id) AS rev_id FROM deliveries JOIN m USING (entity, block) WHERE n_bytes > 0 GROUP BY ALL",
        "latest_revision_per_entity": f"WITH {_DEL} SELECT entity, max(rev_id) AS rev_id FROM deliveries WHERE n_bytes > 0 GROUP BY 1",
        "latest_before_date": f"WITH {_DEL} SELECT entity, max(rev_id) AS rev_id FROM deliveries WHERE '{MAX_DATE}' > rev_timestamp GROUP BY 1",
        "snapshot_per_bucket": f"WITH {_DATED} SELECT entity, CAST(floor({day} / 14.0) * 14 + 13 AS INT) AS bucket, max(rev_id) AS rev_id FROM dated WHERE edit_date IS NOT NULL GROUP BY ALL",
        "day_index_roundtrip": f"WITH {_DATED} SELECT {day} AS day, strftime(edit_date, '%Y-%m-%d') AS date, CAST(floor({day} / 14.0) * 14 + 13 AS INT) AS bucket, count(*) AS n_rows FROM dated WHERE edit_date IS NOT NULL GROUP BY ALL",
        "union_sources": "SELECT CAST(CASE WHEN delivered_at >= TIMESTAMP '2013-10-01' THEN 0 WHEN delivered_at >= TIMESTAMP '2013-07-01' THEN 1 WHEN delivered_at >= TIMESTAMP '2013-04-01' THEN 2 WHEN delivered_at >= TIMESTAMP '2013-01-01' THEN 3 ELSE 4 END AS INT) AS file_rank, count(*) AS n_rows, count(DISTINCT rev_id) AS n_revisions FROM revision GROUP BY 1",
        "period_changes": f"WITH {_DELTA} SELECT wd_day, changed_items, new_items FROM deltas",
        "period_deltas": f"WITH {_DELTA} SELECT * FROM deltas",
        "historic_running_totals": f"WITH {_DELTA} SELECT strftime(DATE '2012-01-01' + wd_day, '%Y-%m-%d') AS date, {run('new_items', 'total_items')}, changed_items, {', '.join(run(c, n) for c, n in snapshots.MEASURES.items())}, {run('with_statements', 'items_with_statements')} FROM deltas",
        "historic_sums": f"""WITH {_DELTA} SELECT strftime(DATE '2012-01-01' + wd_day, '%Y-%m-%d') AS date, {run('new_items', '"total items"')}, changed_items AS "changed items", {', '.join(run(c, '"' + n.replace('_', ' ') + '"') for c, n in snapshots.MEASURES.items())}, {run('with_statements', '"items with statements"')} FROM deltas""",
        "term_snapshots": f"""WITH {_DATED}, days AS (SELECT rev_id AS rev, CAST(floor({day} / 14.0) * 14 + 13 AS INT) AS day FROM dated WHERE edit_date IS NOT NULL), p AS (SELECT id, day, w.rev, {_size('label')} AS label_num, {_size('description')} AS desc_num, {_ALIASES} AS alias_num FROM wb_items w JOIN days USING (rev)),
 r AS (SELECT *, row_number() OVER (PARTITION BY id, day ORDER BY rev DESC, label_num DESC, desc_num DESC, alias_num DESC) AS k FROM p) SELECT id, day, CAST(rev AS BIGINT) AS rev, label_num, desc_num, alias_num FROM r WHERE k = 1""",
        "snapshot_days": "SELECT DISTINCT wd_day FROM itemrevstats WHERE wd_day IS NOT NULL ORDER BY 1",
        "previous_snapshot": f"WITH {_SNAP} SELECT id, wd_day, stat_num, lag(wd_day) OVER w AS previous_day, lag(stat_num) OVER w AS previous_stat_num FROM snaps WINDOW w AS (PARTITION BY id ORDER BY wd_day)",
        "replace_snapshots": f"WITH {_SNAP} SELECT id, wd_day, rev, {_MEASURES} FROM snaps",
        "upsert_snapshots": "WITH r AS (SELECT id, rev, wd_day, stat_num, CASE WHEN loaded_at >= TIMESTAMP '2013-07-01' THEN 1 ELSE 0 END AS late FROM itemrevstats), h AS (SELECT late, id, wd_day, rev, max(stat_num) AS stat_num FROM r GROUP BY ALL) SELECT id, rev, wd_day, stat_num FROM (SELECT *, row_number() OVER (PARTITION BY id, wd_day ORDER BY rev DESC, late DESC) AS k FROM h) WHERE k = 1",
        "upsert_entities": "SELECT id, rev, CAST(length(claims) AS INT) AS claims_length, md5(coalesce(label, '')) AS label_md5 FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rev DESC, claims DESC NULLS LAST, links DESC NULLS LAST, label DESC NULLS LAST) AS k FROM wb_items) WHERE k = 1",
        "stored_revision_lookup": f"WITH {_DEL}, e AS (SELECT DISTINCT CAST(substr(entity, 2) AS BIGINT) AS id FROM deliveries WHERE is_item) SELECT e.id, CAST(coalesce(max(i.rev), -1) AS BIGINT) AS stored_rev FROM e LEFT JOIN wb_items i ON i.id = e.id GROUP BY 1",
    }


def queries() -> dict:
    return {n: globals()[n] for n in oracle_sql()}
