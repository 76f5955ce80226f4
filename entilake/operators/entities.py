"""Contents of entities: terms, site links, metrics, compact forms."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entilake.functions import dims
from entilake.functions.text import page_name, quote_path

STRICT = {"allowSingleQuotes": "false"}


def json_map(text: Column) -> Column:
    """A JSON object as MAP<STRING,VARIANT>; an empty map for NULL, lists and anything else, as contents default."""
    return F.coalesce(F.from_json(text, "map<string,variant>", STRICT), F.create_map().cast("map<string,variant>"))


def is_text(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def terms(df: DataFrame, keys: list[str], kinds: tuple[str, ...] = ("label", "description", "aliases")) -> DataFrame:
    """One row per term: keys, term_kind, lang, text. A value that is no text, as the 1 that stands for a text that was
    left out, gives a row with a NULL text. Aliases are lists, or objects of which the values count; each gives a row. The
    words of one language come in no order. All kinds come from one pass over `df`."""

    def found(kind: str) -> Column:
        name = F.lit({"aliases": "alias"}.get(kind, kind))
        term = lambda lang, v: F.struct(name.alias("term_kind"), lang.alias("lang"), F.when(is_text(v), v.cast("string")).alias("text"))
        entries = F.map_entries(json_map(F.col(kind)))
        if kind != "aliases":
            return F.transform(entries, lambda e: term(e["key"], e["value"]))
        values = lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.map_values(F.try_variant_get(v, "$", "map<string,variant>")), F.array(v))
        return F.flatten(F.transform(entries, lambda e: F.transform(values(e["value"]), lambda v: term(e["key"], v))))

    return df.select(*keys, F.explode(F.concat(*[found(k) for k in kinds])).alias("_t")).select(*keys, "_t.*")


def site_links(df: DataFrame, keys: list[str], links: str = "links") -> DataFrame:
    """One row per site link: keys, site, page. Both forms of a link are read, the name and the object with a name."""
    each = df.select(*keys, F.explode(json_map(F.col(links))).alias("site", "_v"))
    page = F.when(is_text(F.col("_v")), F.col("_v").cast("string")).otherwise(F.try_variant_get("_v", "$.name", "string"))
    return each.select(*keys, "site", page.alias("page")).where(F.col("page").isNotNull())


def article_url(site: Column, page: Column) -> Column:
    """Address of a linked page; NULL for a site that is not understood."""
    return F.concat(dims.site_prefix(site), quote_path(page_name(page)))


def counts_of(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, label_num, desc_num, link_num, alias_num: languages of labels and descriptions, links, and aliases summed over
    languages."""
    size = lambda c: F.size(json_map(F.col(c)))
    lists = F.transform(F.map_values(json_map(F.col("aliases"))), lambda v: F.coalesce(F.size(F.try_variant_get(v, "$", "array<variant>")), F.lit(0)))
    alias = F.aggregate(lists, F.lit(0), lambda n, k: n + F.greatest(k, F.lit(0)))
    links = size("links") if "links" in df.columns else F.lit(0)
    return df.select(*keys, size("label").alias("label_num"), size("description").alias("desc_num"), links.alias("link_num"), alias.alias("alias_num"))


def claim_counts(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, stat_num, stat_ref_num, stat_q_num: claims, claims with references, claims with qualifiers; from labelled
    nodes of the types claim, reference and qualifier."""
    claim = F.get("dewey", F.lit(0))
    of = lambda path: F.count_distinct(F.when(F.col("path") == path, claim)).cast("int")
    return nodes.groupBy(*keys).agg(of("claim").alias("stat_num"), of("reference").alias("stat_ref_num"), of("qualifier").alias("stat_q_num"))


def reduced_map(text: Column, keep: str = "en") -> Column:
    """A JSON object with the text of one language kept and 1 for all others, as JSON in key order."""
    m = json_map(text)
    pairs = F.transform(F.array_sort(F.map_keys(m)), lambda k: F.concat(F.to_json(F.array(k)).substr(F.lit(2), F.length(F.to_json(F.array(k))) - 2), F.lit(":"), F.when(k == keep, F.to_json(F.try_element_at(m, k))).otherwise("1")))
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def _compact_snak(snak: Any) -> Any:
    if isinstance(snak, list) and len(snak) > 3 and snak[0] == "value":
        prop, kind, v = snak[1:4]
        if kind == "wikibase-entityid" and isinstance(v, dict) and v.get("entity-type") == "item":
            return ["R", prop, v.get("numeric-id")]
        if kind == "string":
            return ["S", prop, v]
        if kind == "time" and isinstance(v, dict):
            calendar = v.get("calendarmodel")
            return ["T", prop, v.get("precision"), v.get("time"), v.get("timezone"), calendar[35:] if isinstance(calendar, str) else None, v.get("after"), v.get("before")]
    return snak


def compact_claims(df: DataFrame, keys: list[str], claims: str, claim_list: Any) -> DataFrame:
    """keys and compact_claims: the claims in their compact form as JSON. The guid goes, and the rank where it is 1, and
    empty lists; snaks of items, strings and times are shortened. Compact input stays as it is. NULL where the text is not
    complete."""
    source = df.select(*keys, F.col(claims).alias("_text"))

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for batch in batches:
            out = []
            for t in batch.column(len(keys)):
                text = t.as_py()
                found = claim_list(text) if text else None
                out.append(None if found is None else json.dumps([_compact_claim(c) for c in found], ensure_ascii=False, separators=(",", ":"), default=str))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.string())], names=[*keys, "compact_claims"])

    return source.mapInArrow(run, T.StructType([*[source.schema[k] for k in keys], T.StructField("compact_claims", T.StringType())]))


def _compact_claim(claim: Any) -> Any:
    from entilake.operators.shred import children

    if not isinstance(claim, dict):
        return claim
    out = {k: v for k, v in claim.items() if k not in ("g", "m", "q", "refs", "rank")}
    if claim.get("m") is not None:
        out["m"] = _compact_snak(claim["m"])
    if claim.get("q"):
        out["q"] = [_compact_snak(s) for s in children(claim["q"])]
    if claim.get("refs"):
        out["refs"] = [[_compact_snak(s) for s in children(r)] for r in children(claim["refs"])]
    if claim.get("rank") not in (None, 1):
        out["rank"] = claim["rank"]
    return out


