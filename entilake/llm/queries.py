"""Queries p4 and p7 to p9: the operators for training text on the tables, and the SQL for what SQL can say about them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entilake.llm import frequent, langid, mixing, packing
from entilake.llm.tokens import token_counts
from entilake.session import cut
from entilake.sources.tables import table


#: Share of the rows from which a user name is frequent.
FREQUENT_SHARE = 0.005


def p4_top_users(spark: SparkSession, d: str) -> DataFrame:
    """The frequent names with their approximate and exact counts."""
    found = frequent.frequent_values(table(spark, d, "revision", "user_name"), "user_name", FREQUENT_SHARE)
    return found.select("user_name", "approx_count", "exact_count", "exact_share")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_top_users(spark, d).select("user_name")


def p4_exact_counts(spark: SparkSession, d: str) -> DataFrame:
    """The counts of p4_top_users, and whether the approximate ones are bounds of them."""
    found = p4_top_users(spark, d)
    return found.select("user_name", "exact_count", "exact_share", (F.col("approx_count") >= F.col("exact_count")).alias("is_bounded"))


def _capacity(spark: SparkSession, d: str) -> int:
    return table(spark, d, "pack_bins", "capacity_tokens").agg(F.min("capacity_tokens")).first()[0]


def _packed(spark: SparkSession, d: str) -> tuple[DataFrame, int]:
    sizes = cut(token_counts(table(spark, d, "documents", "doc_id", "text"), ["doc_id"]))
    capacity = _capacity(spark, d)
    return packing.pack(sizes, "doc_id", "n_tokens", capacity), capacity


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    packed, _ = _packed(spark, d)
    return packed.where("n_pieces > 1 and piece_no = 0").select("doc_id")


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """The container of each document, or of each piece of one that is too large."""
    return _packed(spark, d)[0]


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers used, the least possible number, and the unused share."""
    packed, capacity = _packed(spark, d)
    bins = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("n"))
    found = bins.agg(F.count("*").alias("n_containers"), F.max("n").alias("fullest"), F.sum("n").alias("n_tokens"))
    return found.select("n_containers", "fullest", "n_tokens", F.ceil(F.col("n_tokens") / capacity).alias("least_possible"), (1 - F.col("n_tokens") / (F.col("n_containers") * capacity)).alias("unused_share"))


def p7_audit(spark: SparkSession, d: str) -> DataFrame:
    """Documents, and how many break a rule: containers that hold more than the capacity, documents whose pieces are not the
    whole text, and documents split although they fit."""
    docs = table(spark, d, "documents", "doc_id", "text")
    sizes = cut(token_counts(docs, ["doc_id"]))
    capacity = _capacity(spark, d)
    packed = cut(packing.pack(sizes, "doc_id", "n_tokens", capacity))
    over = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("n")).where(F.col("n") > capacity).count()
    whole = packed.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("pieces"), F.max(F.col("first_token") + F.col("n_tokens")).alias("end"))
    both = sizes.join(whole, "doc_id", "left")
    fits = (F.col("n").eqNullSafe(F.col("n_tokens").cast("bigint"))) & (F.col("end") == F.col("n"))
    counts = both.agg(F.count("*").alias("n_documents"), F.count_if(~F.coalesce(fits, F.lit(False))).alias("incomplete_documents"), F.count_if((F.col("n_tokens") <= capacity) & (F.col("pieces") > 1)).alias("needless_splits"))
    return counts.withColumn("overfull_containers", F.lit(over).cast("bigint"))


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """All possible uses with their finish times, those in the mix, the targets and the budget."""
    docs = cut(token_counts(table(spark, d, "documents", "doc_id", "source", "text"), ["doc_id", "source"]))
    targets = cut(mixing.targets_of(table(spark, d, "mix_targets"), "source", "target_share", "max_repeats"))
    budget = mixing.budget_of(docs, targets)
    times = cut(mixing.finish_times(docs, targets, budget))
    return times, mixing.cut_at_budget(times, budget), targets, budget


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing.short_sources(*_mixed(spark, d))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """How often each document is used."""
    return _mixed(spark, d)[1].groupBy("doc_id", "source").agg(F.count("*").alias("n_uses"), F.max("n_tokens").alias("n_tokens"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual shares of the sources."""
    _, mixed, targets, _ = _mixed(spark, d)
    return mixing.shares(mixed, targets)


def p8_audit(spark: SparkSession, d: str) -> DataFrame:
    """Per source with a target: documents used more often than max_repeats, whether any is used a second time before all are
    used once, and whether the whole mix ends within one document of the budget."""
    times, mixed, targets, budget = _mixed(spark, d)
    uses = mixed.groupBy("source", "doc_id").agg(F.count("*").alias("n"), F.max("replica").alias("last"))
    per = uses.join(targets, "source").groupBy("source").agg(F.count_if(F.col("n") > F.col("_repeats")).alias("over_cap"), (F.max("n") - F.min("n") <= 1).alias("is_even"))
    got = mixed.agg(F.sum("n_tokens")).first()[0] or 0
    ends = times.agg(F.max("n_tokens").alias("largest"), F.sum("n_tokens").alias("possible")).first()
    full = got <= budget and got > min(budget, ends["possible"] or 0) - (ends["largest"] or 0) - 1
    rows = targets.select("source").join(per, "source", "left")
    return rows.select("source", F.coalesce("over_cap", F.lit(0)).alias("over_cap"), F.coalesce("is_even", F.lit(True)).alias("is_even"), F.lit(full).alias("ends_at_budget"))


def _identified(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text", "lang", "source", "page_title")
    return langid.identify(docs, table(spark, d, "languages"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Languages of the segments that are sure, of the documents that have more than one or another one than their label."""
    sure = F.filter("segments", lambda s: s["confidence"] >= langid.SURE)
    found = _identified(spark, d).withColumn("_codes", F.array_distinct(F.transform(sure, lambda s: s["lang_code"])))
    named = (F.size("_codes") == 1) & F.coalesce(F.get("_codes", F.lit(0)) == F.col("label_code"), F.lit(False))
    return found.where(~named).select("doc_id", F.explode("_codes").alias("lang_code"))


def p9_segments(spark: SparkSession, d: str) -> DataFrame:
    """Language and confidence of each segment."""
    rows = _identified(spark, d).select("doc_id", F.posexplode("segments").alias("segment_no", "s"))
    return rows.select("doc_id", "segment_no", F.col("s.start").alias("start_char"), F.col("s.stop").alias("end_char"), "s.lang_code", "s.confidence")


def p9_documents(spark: SparkSession, d: str) -> DataFrame:
    """Main language of each document with a confidence, and whether it mixes languages."""
    mixed = F.size(F.array_distinct(F.transform("segments", lambda s: s["lang_code"]))) > 1
    return _identified(spark, d).select("doc_id", "lang_code", "confidence", mixed.alias("is_mixed"), "label_code")


def p9_labels(spark: SparkSession, d: str) -> DataFrame:
    """The language each document's label names."""
    codes, names = langid.label_index(table(spark, d, "languages"))
    labelled = langid.with_label(table(spark, d, "documents", "doc_id", "lang"), "lang", names)
    return labelled.select("doc_id", F.get(F.array(*[F.lit(c) for c in codes]), F.col("label")).alias("label_code"))


def p9_audit(spark: SparkSession, d: str) -> DataFrame:
    """Documents, and how many break a rule: no language, a confidence outside 0 to 1, segments that leave the text, overlap
    or are out of order, neighbours of one language that are two segments."""
    found = _identified(spark, d).join(table(spark, d, "documents", "doc_id", "n_chars"), "doc_id", "left")
    s = F.col("segments")
    pairs = F.zip_with(F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))), F.slice(s, 2, F.greatest(F.size(s), F.lit(1))), lambda a, b: (b["start"] < a["stop"]) | (a["lang_code"] == b["lang_code"]))
    inside = F.forall(s, lambda x: (x["start"] >= 0) & (x["start"] < x["stop"]) & (x["stop"] <= F.col("n_chars")) & x["confidence"].between(0, 1))
    n = lambda cond, name: F.count_if(~F.coalesce(cond, F.lit(False))).alias(name)
    return found.agg(F.count("*").alias("n_documents"), n(F.col("lang_code").isNotNull() & F.col("confidence").between(0, 1), "without_language"), n(inside, "outside_text"), n(~F.exists(pairs, lambda x: x), "not_in_order"))


def queries() -> dict:
    names = ("p4_found", "p4_top_users", "p4_exact_counts", "p7_found", "p7_containers", "p7_fill", "p7_audit", "p8_found", "p8_mix", "p8_shares", "p8_audit", "p9_found", "p9_segments", "p9_documents", "p9_labels", "p9_audit")
    return {n: globals()[n] for n in names}


def oracle_sql() -> dict[str, str]:
    """SQL has no tokenizer and no models; for p7 to p9 it states what must hold for every row of the tables."""
    counted = "SELECT user_name, count(*) AS n FROM revision WHERE user_name IS NOT NULL GROUP BY 1"
    frequent_ = f"n >= {FREQUENT_SHARE} * (SELECT count(user_name) FROM revision)"
    label = r"""lower(trim(regexp_replace(lang, '^\s+|\s+$', '', 'g')))"""
    return {
        "p4_found": f"SELECT user_name FROM ({counted}) WHERE {frequent_}",
        "p4_exact_counts": f"SELECT user_name, n AS exact_count, n / (SELECT count(user_name) FROM revision) AS exact_share, true AS is_bounded FROM ({counted}) WHERE {frequent_}",
        "p7_audit": "SELECT count(*) AS n_documents, CAST(0 AS BIGINT) AS incomplete_documents, CAST(0 AS BIGINT) AS needless_splits, CAST(0 AS BIGINT) AS overfull_containers FROM documents",
        "p8_audit": "SELECT source, CAST(0 AS BIGINT) AS over_cap, true AS is_even, true AS ends_at_budget FROM mix_targets WHERE target_share > 0",
        "p9_labels": f"WITH n AS (SELECT lower(trim(unnest([code, tag, iso3, english_title]))) AS name, code FROM languages), m AS (SELECT name, min(code) AS code FROM n WHERE name <> '' GROUP BY 1) SELECT doc_id, coalesce(a.code, b.code) AS label_code FROM documents LEFT JOIN m a ON a.name = {label} LEFT JOIN m b ON b.name = regexp_extract({label}, '^(\\w+?)[-_]\\w+$', 1)",
        "p9_audit": "SELECT count(*) AS n_documents, CAST(0 AS BIGINT) AS without_language, CAST(0 AS BIGINT) AS outside_text, CAST(0 AS BIGINT) AS not_in_order FROM documents",
    }
