"""Queries on the contents of stored entities, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entilake.functions import dims, text, times
from entilake.operators import entities, revisions, snapshots
from entilake.operators.wide import VALUE_KIND, fits
from entilake.sources import side_inputs
from entilake.sources.claims import SNAK_PATHS, claim_labels, claim_list, claim_nodes
from entilake.sources.tables import current_rows, table

LANGUAGES = ["en", "de", "pt-br"]
SITES = ["enwiki", "dewiki", "dewikivoyage"]


def _items(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return current_rows(table(spark, d, "wb_items", "id", "rev", *columns), "id", "rev", *columns)


def _properties(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return current_rows(table(spark, d, "wb_properties", "id", "rev", *columns), "id", "rev", *columns)


def _types(spark: SparkSession, d: str) -> DataFrame:
    """(property_id, datatype, property_range): the declared datatype of each property, if it is a known one; the table of
    properties is small by nature, but nothing here depends on it."""
    rows = _properties(spark, d, "datatype")
    known = dims.canonical_datatype(F.col("datatype"))
    return rows.select(F.col("id").alias("property_id"), known.alias("datatype"), dims.property_range(known).alias("property_range"))


def _snaks(spark: SparkSession, d: str) -> DataFrame:
    """All snaks of the items with their context and datatype: that of the value type, but for strings that of the
    property, which may be a file or an address."""
    nodes = claim_nodes(_items(spark, d, "claims"), ["id"], only=SNAK_PATHS)
    context = F.when(F.col("path") == "main", "v").when(F.col("path") == "qualifier", "q").otherwise("r")
    typed = nodes.join(_types(spark, d), "property_id", "left")
    by_value = F.try_element_at(dims.literal_map(dims.TYPE_OF_VALUE), F.col("vtype"))
    snak_type = F.when(F.col("kind") != "value", F.col("datatype")).when(F.col("vtype") == "string", F.coalesce("datatype", F.lit("string"))).otherwise(by_value)
    return typed.withColumn("context", context).withColumn("snak_type", snak_type)


def terms(spark: SparkSession, d: str) -> DataFrame:
    found = entities.terms(_items(spark, d, "label", "description", "aliases"), ["id"])
    return found.withColumn("tag", dims.language_tag(F.col("lang"))).where("tag is not null and text is not null").select("id", "term_kind", "lang", "tag", "text")


def term_literals(spark: SparkSession, d: str) -> DataFrame:
    rows = terms(spark, d)
    return rows.select("id", "term_kind", "lang", text.string_literal(F.col("text"), F.col("tag")).alias("literal"))


def language_filter(spark: SparkSession, d: str) -> DataFrame:
    found = entities.terms(_items(spark, d, "label", "description", "aliases"), ["id"])
    return found.where(F.col("lang").isin(*LANGUAGES)).groupBy("lang", "term_kind").agg(F.count("*").alias("n_terms"), F.count("text").alias("n_texts"))


def site_links(spark: SparkSession, d: str) -> DataFrame:
    rows = entities.site_links(_items(spark, d, "links"), ["id"])
    url = entities.article_url(F.col("site"), F.col("page"))
    return rows.withColumn("url", url).where("url is not null").select("id", "site", "page", "url", dims.site_language(F.col("site")).alias("language"))


def site_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = entities.site_links(_items(spark, d, "links"), ["id"])
    return rows.where(F.col("site").isin(*SITES)).groupBy("site").agg(F.count("*").alias("n_links"), F.count_distinct("id").alias("n_items"))


def content_metrics(spark: SparkSession, d: str) -> DataFrame:
    items = _items(spark, d, "claims", "links", "label", "aliases", "description")
    counts = entities.claim_counts(claim_labels(items, ["id"], only=["claim", "reference", "qualifier"]), ["id"])
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return entities.counts_of(items, ["id"]).join(counts, "id", "left").select("id", zero("stat_num"), zero("stat_ref_num"), zero("stat_q_num"), "label_num", "desc_num", "link_num", "alias_num")


def property_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = _properties(spark, d, "label", "aliases", "description")
    return entities.counts_of(rows, ["id"]).select("id", "label_num", "desc_num", "alias_num")


def property_usage(spark: SparkSession, d: str) -> DataFrame:
    """Uses of each property as main property, in qualifiers and in references; most used first."""
    n = lambda c: F.count_if(F.col("context") == c)
    used = _snaks(spark, d).where("property_id is not null").groupBy("property_id").agg(n("v").alias("main"), n("q").alias("qualifiers"), n("r").alias("references"))
    return used.orderBy(F.desc("main"), "property_id")


def type_stats(spark: SparkSession, d: str) -> DataFrame:
    return _snaks(spark, d).groupBy("context", F.coalesce("snak_type", F.lit("unknown")).alias("datatype")).agg(F.count("*").alias("n_snaks"))


def property_type_filter(spark: SparkSession, d: str) -> DataFrame:
    """Claims whose main datatype is an item or a time; claims of unknown types are not included."""
    kept = _snaks(spark, d).where("context = 'v'").where(F.coalesce(F.col("snak_type").isin("wikibase-item", "time"), F.lit(False)))
    return kept.groupBy("property_id").agg(F.count("*").alias("n_claims"), F.count_distinct("id").alias("n_items"))


def property_types(spark: SparkSession, d: str) -> DataFrame:
    return _types(spark, d)


def size_totals(spark: SparkSession, d: str) -> DataFrame:
    size = lambda c: F.coalesce(F.sum(F.length(c)), F.lit(0)).cast("bigint").alias(f"{c}_chars")
    return _items(spark, d, "claims", "links", "label", "aliases", "description").agg(F.count("*").alias("entities"), *[size(c) for c in ("claims", "links", "label", "aliases", "description")])


def snak_sequence(spark: SparkSession, d: str) -> DataFrame:
    """Runs of neighbouring claims with one property."""
    rows = claim_nodes(_items(spark, d, "claims"), ["id"], only=["main"]).select("id", F.get("dewey", F.lit(0)).alias("claim_no"), "property_id")
    return revisions.consecutive_groups(rows, "id", ["claim_no"], "property_id")


def property_roles(spark: SparkSession, d: str) -> DataFrame:
    """Uses of each property in each item by role: main, qualifier or reference."""
    return snapshots.property_roles(_items(spark, d, "claims"), ["id"])


def compact_snaks(spark: SparkSession, d: str) -> DataFrame:
    """The snaks of the claims in compact form, to be the same as those of the claims as they came."""
    compact = entities.compact_claims(_items(spark, d, "claims"), ["id"], "claims", claim_list)
    nodes = claim_nodes(compact, ["id"], "compact_claims", only=SNAK_PATHS)
    at = F.array_join(F.transform("dewey", lambda x: x.cast("string")), ".")
    return nodes.select("id", "path", at.alias("snak_label"), "kind", "property_id", "vtype", "entity_id", "amount", "time", "time_precision")


def property_types_with_seed(spark: SparkSession, d: str) -> DataFrame:
    """Types of properties: the declared ones, and for all others met in claims those of their values as a seed list, the
    first by name where values differ."""
    seed = _snaks(spark, d).where("kind = 'value' and property_id is not null and snak_type is not null").select("property_id", F.col("snak_type").alias("datatype")).distinct()
    return side_inputs.property_types(_types(spark, d), seed)


def reduced_terms(spark: SparkSession, d: str) -> DataFrame:
    rows = _items(spark, d, "label", "description")
    return rows.select("id", entities.reduced_map(F.col("label")).alias("label"), entities.reduced_map(F.col("description")).alias("description"))


def compact_claims(spark: SparkSession, d: str) -> DataFrame:
    """Claims in compact form: number of claims is that of the source, and a second pass changes nothing."""
    return entities.compact_claims(_items(spark, d, "claims"), ["id"], "claims", claim_list)


def time_literals(spark: SparkSession, d: str) -> DataFrame:
    rows = claim_nodes(_items(spark, d, "claims"), ["id"], only=SNAK_PATHS).where("vtype = 'time' and time is not null")
    literal = times.time_literal(F.col("time"), F.col("time_precision"))
    return rows.groupBy("time", "time_precision").agg(F.count("*").alias("n")).withColumn("literal", literal)


def coordinate_literals(spark: SparkSession, d: str) -> DataFrame:
    rows = claim_nodes(_items(spark, d, "claims"), ["id"], only=SNAK_PATHS).where("vtype = 'globecoordinate' and latitude is not null")
    return rows.select("id", "latitude", text.float_literal(F.col("latitude")).alias("literal")).distinct()


def document_literals(spark: SparkSession, d: str) -> DataFrame:
    """String literals and percent-encoded forms of whole texts, as hashes."""
    rows = table(spark, d, "documents", "doc_id", "text").where("text is not null")
    return rows.select("doc_id", F.md5(text.string_literal(F.col("text"))).alias("literal_md5"), F.md5(text.quote_path(text.page_name(F.col("text")))).alias("quoted_md5"))


def language_tags(spark: SparkSession, d: str) -> DataFrame:
    rows = entities.terms(_items(spark, d, "label", "description"), ["id"], ("label", "description"))
    return rows.groupBy("lang").agg(F.count("*").alias("n")).withColumn("tag", dims.language_tag(F.col("lang"))).where("tag is not null")


def vocabulary_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Triples of the system vocabulary by predicate and, for types, by kind."""
    rows = dims.vocabulary_triples(spark).select("p", F.when(F.col("p") == "a", F.col("o")).alias("kind"))
    return rows.groupBy("p", "kind").agg(F.count("*").alias("n"))


def used_datatypes(spark: SparkSession, d: str) -> DataFrame:
    """The individuals of the vocabulary and the number of properties that declare them."""
    individuals = spark.createDataFrame([(i, t) for t, i in dims.TYPE_INDIVIDUALS.items()], "individual string, datatype string")
    declared = _types(spark, d).where("datatype is not null").groupBy("datatype").agg(F.count("*").alias("n"))
    terms_ = dims.vocabulary(spark).where("kind = 'wo:Datatype'").select(F.col("term").alias("individual"))
    return terms_.join(individuals, "individual", "left").join(declared, "datatype", "left").select("individual", F.coalesce("n", F.lit(0)).alias("n_properties"))


def misfits_by_type(spark: SparkSession, d: str) -> DataFrame:
    """Fitting and other main snaks by datatype."""
    types = _types(spark, d).where("datatype is not null").select("property_id", F.lower("datatype").alias("declared"))
    rows = claim_nodes(_items(spark, d, "claims"), ["id"], only=["main"]).join(types, "property_id")
    return rows.groupBy("declared").agg(F.count_if(fits(F.col("declared"))).alias("n_fit"), F.count_if(~fits(F.col("declared"))).alias("n_misfit"))


def _current(name: str) -> str:
    return f"cur AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rev DESC, claims DESC NULLS LAST) AS k FROM {name} WHERE id IS NOT NULL) WHERE k = 1)"


def claims_cte(name: str = "wb_items") -> str:
    """Common table expressions cur, claims(id, rev, claim_no, c) and snaks(id, rev, claim_no, snak_place, group_no, snak_no, s)."""
    return rf"""{_current(name)},
 t1 AS (SELECT id, rev, trim(claims, E' \t\r\n') AS t FROM cur WHERE claims IS NOT NULL),
 t2 AS (SELECT id, rev, CASE WHEN regexp_matches(t, '^[\[{{\s]*&quot;') THEN replace(t, '&quot;', '"') ELSE t END AS t FROM t1),
 t3 AS (SELECT id, rev, CASE WHEN t LIKE '"%' AND json_valid(t) THEN json_extract_string(t, '$') ELSE t END AS t FROM t2),
 t4 AS (SELECT id, rev, t, json_type(t) AS kind FROM t3 WHERE json_valid(t)),
 roots AS (SELECT id, rev, CASE kind WHEN 'ARRAY' THEN json_extract(t, '$[*]') WHEN 'OBJECT' THEN flatten(list_transform(json_extract(t, '$.*'), lambda x: json_extract(x, '$[*]'))) END AS cl FROM t4),
 claims AS (SELECT id, rev, CAST(unnest(range(len(cl))) AS INT) AS claim_no, unnest(cl) AS c FROM roots),
 parts AS (SELECT id, rev, claim_no, json_extract(c, '$.m') AS m, json_extract(c, '$.q[*]') AS q, CASE json_type(json_extract(c, '$.refs')) WHEN 'OBJECT' THEN json_extract(c, '$.refs.*') ELSE json_extract(c, '$.refs[*]') END AS refs FROM claims),
 groups AS (SELECT id, rev, claim_no, CAST(unnest(range(len(refs))) AS INT) AS group_no, json_extract(unnest(refs), '$[*]') AS g FROM parts),
 snaks AS (SELECT id, rev, claim_no, 'm' AS snak_place, CAST(0 AS INT) AS group_no, CAST(0 AS INT) AS snak_no, m AS s FROM parts WHERE m IS NOT NULL AND json_type(m) <> 'NULL'
  UNION ALL SELECT id, rev, claim_no, 'q', CAST(0 AS INT), CAST(unnest(range(len(q))) AS INT), unnest(q) FROM parts
  UNION ALL SELECT id, rev, claim_no, 'r', group_no, CAST(unnest(range(len(g))) AS INT), unnest(g) FROM groups)"""


_TYPED = """types AS (SELECT id AS property_id, CASE lower(trim(datatype)) {cases} END AS datatype FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rev DESC, datatype DESC NULLS LAST) AS k FROM wb_properties WHERE id IS NOT NULL) WHERE k = 1)""".format(
    cases=" ".join(f"WHEN '{t.lower()}' THEN '{t}'" for t in dims.TYPE_INDIVIDUALS)
)
_DECODED = """decoded AS (SELECT *, json_extract_string(s, '$[0]') AS tag, try_cast(json_extract_string(s, '$[1]') AS INT) AS property_id,
 CASE json_extract_string(s, '$[0]') WHEN 'value' THEN json_extract_string(s, '$[2]') WHEN 'R' THEN 'wikibase-entityid' WHEN 'S' THEN 'string' WHEN 'T' THEN 'time' END AS vtype FROM snaks)"""
def snaks_sql(name: str = "wb_items") -> str:
    """Common table expressions up to full_snaks: decoded snaks with context, declared and own datatype."""
    own = " ".join(f"WHEN '{v}' THEN '{t}'" for v, t in dims.TYPE_OF_VALUE.items())
    return f"""{claims_cte(name)}, {_TYPED}, {_DECODED}, full_snaks AS (SELECT decoded.*, datatype, CASE snak_place WHEN 'm' THEN 'v' ELSE snak_place END AS context,
 CASE WHEN tag NOT IN ('value', 'R', 'S', 'T') THEN datatype WHEN vtype = 'string' THEN coalesce(datatype, 'string') ELSE CASE vtype {own} END END AS snak_type
 FROM decoded LEFT JOIN types USING (property_id))"""


_SNAKS = snaks_sql()
_SITE_TAG = "CASE lang {} ELSE CASE WHEN regexp_full_match(lang, '[a-z]{{2,3}}') AND NOT regexp_full_match(lang, 'q[a-t][a-z]') THEN lang END END".format(" ".join(f"WHEN '{c}' THEN '{t}'" for c, t in dims.LANGUAGE_TAGS.items()))
_OWN = f"(regexp_full_match(lang, '[a-z][a-z]') AND lang NOT IN ({', '.join(repr(x) for x in dims.NO_TAGS)})) OR lang IN ({', '.join(repr(x) for x in dims.OWN_TAGS)})"
_TAG = "CASE lang {} ELSE CASE WHEN {own} THEN lang END END".format(" ".join(f"WHEN '{c}' THEN '{t}'" for c, t in dims.LANGUAGE_TAGS.items()), own=_OWN)


def terms_sql(name: str = "wb_items") -> str:
    """Common table expressions up to terms(id, term_kind, lang, text)."""
    return f"""{_current(name)}, lab AS (SELECT eid AS id, 'label' AS term_kind, j.key AS lang, j.type, j.value FROM (SELECT id AS eid, label AS x FROM cur WHERE json_valid(label) AND json_type(label) = 'OBJECT') , json_each(x) AS j
 UNION ALL SELECT eid, 'description', j.key, j.type, j.value FROM (SELECT id AS eid, description AS x FROM cur WHERE json_valid(description) AND json_type(description) = 'OBJECT'), json_each(x) AS j),
 al AS (SELECT eid AS id, j.key AS lang, unnest(json_extract(j.value, '$[*]')) AS value FROM (SELECT id AS eid, aliases AS x FROM cur WHERE json_valid(aliases) AND json_type(aliases) = 'OBJECT'), json_each(x) AS j),
 terms AS (SELECT id, term_kind, lang, CASE WHEN type = 'VARCHAR' THEN json_extract_string(value, '$') END AS text FROM lab UNION ALL SELECT id, 'alias', lang, CASE WHEN json_type(value) = 'VARCHAR' THEN json_extract_string(value, '$') END FROM al)"""


_TERMS = terms_sql()
_LINKS = f"""{_current('wb_items')}, links AS (SELECT eid AS id, j.key AS site, CASE WHEN j.type = 'VARCHAR' THEN json_extract_string(j.value, '$') ELSE json_extract_string(j.value, '$.name') END AS page
 FROM (SELECT id AS eid, links AS x FROM cur WHERE json_valid(links) AND json_type(links) = 'OBJECT'), json_each(x) AS j)"""
_QUOTE = "replace(replace(url_encode({x}), '%2F', '/'), '~', '%7E')"
_LITERAL = r"""'"' || replace(replace(replace(replace(replace({x}, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') || '"'"""
_SIZE = "CASE WHEN json_valid({c}) AND json_type({c}) = 'OBJECT' THEN CAST(len(json_keys({c})) AS INT) ELSE 0 END"
_ALIAS = "CASE WHEN json_valid(aliases) AND json_type(aliases) = 'OBJECT' THEN CAST(coalesce(list_sum(list_transform(json_extract(aliases, '$.*'), lambda x: len(json_extract(x, '$[*]')))), 0) AS INT) ELSE 0 END"
_VALUE = "CASE tag WHEN 'value' THEN json_extract(s, '$[3]') WHEN 'T' THEN json_extract(s, '$[3]') ELSE json_extract(s, '$[2]') END"


def _misfit_sql() -> str:
    kinds = " ".join(f"WHEN '{t}' THEN '{v}'" for t, v in VALUE_KIND.items())
    number = r"\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*"
    stamp = r"([+-])(\d+)-(\d{1,2})-(\d{1,2})(T.*)?"
    year, month, day = (f"try_cast(regexp_extract(tm, '^{stamp}$', {k}) AS BIGINT)" for k in (2, 3, 4))
    leap = f"({year} % 4 = 0 AND ({year} % 100 <> 0 OR {year} % 400 = 0))"
    return rf"""{claims_cte()}, {_TYPED}, {_DECODED}, mains AS (SELECT d.*, lower(datatype) AS dt, {_VALUE} AS v, CASE tag WHEN 'T' THEN json_extract_string(s, '$[3]') ELSE json_extract_string(s, '$[3].time') END AS tm,
 try_cast(trim(CASE tag WHEN 'T' THEN json_extract_string(s, '$[2]') ELSE json_extract_string(s, '$[3].precision') END) AS INT) AS tp FROM decoded d JOIN types USING (property_id) WHERE snak_place = 'm' AND datatype IS NOT NULL),
 judged AS (SELECT *, tag IN ('novalue', 'somevalue') OR coalesce(vtype = CASE dt {kinds} END AND CASE dt
 WHEN 'string' THEN json_type(v) = 'VARCHAR'
 WHEN 'commonsmedia' THEN json_type(v) = 'VARCHAR' AND trim(json_extract_string(v, '$')) <> ''
 WHEN 'url' THEN json_type(v) = 'VARCHAR' AND regexp_full_match(json_extract_string(v, '$'), '(?i:https?)://[^\s/?#:@]+[^\s]*')
 WHEN 'wikibase-item' THEN regexp_full_match(CASE tag WHEN 'R' THEN json_extract_string(v, '$') ELSE CASE WHEN lower(json_extract_string(v, '$."entity-type"')) = 'item' THEN json_extract_string(v, '$."numeric-id"') END END, '\s*\d+\s*')
 WHEN 'quantity' THEN regexp_full_match(json_extract_string(v, '$.amount'), '\s*[+-]?\d+(\.\d+)?\s*')
 WHEN 'globe-coordinate' THEN regexp_full_match(json_extract_string(v, '$.latitude'), '{number}') AND abs(try_cast(trim(json_extract_string(v, '$.latitude')) AS DOUBLE)) <= 90 AND regexp_full_match(json_extract_string(v, '$.longitude'), '{number}') AND abs(try_cast(trim(json_extract_string(v, '$.longitude')) AS DOUBLE)) <= 180
 WHEN 'time' THEN CASE WHEN tp <= 9 THEN regexp_matches(tm, '^[+-]\d+(-|$)') WHEN tp = 10 THEN regexp_full_match(tm, '{stamp}') AND {month} BETWEEN 1 AND 12 ELSE regexp_full_match(tm, '{stamp}') AND {month} BETWEEN 1 AND 12 AND {day} BETWEEN 1 AND
  CASE WHEN {month} IN (4, 6, 9, 11) THEN 30 WHEN {month} = 2 THEN CASE WHEN {leap} THEN 29 ELSE 28 END ELSE 31 END END
 END, false) AS ok FROM mains)"""


def _apart_sql() -> str:
    """judged with the columns of a cell and the reason why a value is in none; NULL for the values of cells."""
    sql = _misfit_sql().replace("FROM decoded d JOIN types USING (property_id) WHERE snak_place = 'm' AND datatype IS NOT NULL)", "FROM decoded d LEFT JOIN types USING (property_id) WHERE snak_place = 'm')")
    item = """CASE tag WHEN 'R' THEN json_extract_string(v, '$') ELSE json_extract_string(v, '$."numeric-id"') END"""
    amount = "trim(json_extract_string(v, '$.amount'))"
    return rf"""{sql}, sized AS (SELECT *, CASE WHEN dt IS NULL THEN 'no column' WHEN NOT ok THEN 'misfit' WHEN tag IN ('novalue', 'somevalue') THEN 'no value'
  WHEN dt = 'wikibase-item' AND try_cast(trim({item}) AS BIGINT) IS NULL THEN 'too large' WHEN dt = 'quantity' AND NOT regexp_full_match({amount}, '[+-]?0*\d{{1,29}}(\.\d{{0,9}}0*)?') THEN 'too large' END AS why FROM judged),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY id, property_id, why IS NULL ORDER BY claim_no) AS k FROM sized),
 placed AS (SELECT * EXCLUDE (why), CASE WHEN why IS NULL AND k > 1 THEN 'later' ELSE why END AS reason, {item} AS item, {amount} AS amount FROM ranked)"""


def _refs(name: str) -> str:
    return rf"""SELECT DISTINCT '{name}' AS src_table, id AS src_id, rev AS src_rev, target_kind, ltrim(trim(n), '0') AS digits, CASE WHEN regexp_full_match(trim(n), '0+') THEN 0 ELSE try_cast(trim(n) AS BIGINT) END AS missing_id FROM (WITH {claims_cte(name)}, {_DECODED} SELECT id, rev, CASE tag WHEN 'R' THEN 'item' ELSE lower(trim(json_extract_string(s, '$[3]."entity-type"'))) END AS target_kind,
 CASE tag WHEN 'R' THEN json_extract_string(s, '$[2]') ELSE json_extract_string(s, '$[3]."numeric-id"') END AS n FROM decoded WHERE vtype = 'wikibase-entityid') WHERE regexp_full_match(n, '\s*\d+\s*') AND target_kind IN ('item', 'property')""".replace("\\\\", "\\")


_GONE = "gone AS (SELECT entity_id FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY logged_at DESC, log_id DESC) AS k FROM deletion_log) WHERE k = 1 AND lower(trim(log_action)) = 'delete')"
_MISSING = f"""{_GONE}, r AS ({_refs('wb_items')} UNION ALL {_refs('wb_properties')}), missing AS (SELECT * FROM r
 WHERE missing_id IS NULL OR NOT CASE target_kind WHEN 'item' THEN missing_id IN (SELECT id FROM wb_items WHERE id IS NOT NULL) AND missing_id NOT IN (SELECT entity_id FROM gone WHERE entity_id IS NOT NULL) ELSE missing_id IN (SELECT id FROM wb_properties WHERE id IS NOT NULL) END)"""
_P1 = """o AS (SELECT id, wd_day, max(rev) AS rev FROM itemrevstats WHERE stat_num IS NOT NULL AND id IS NOT NULL AND wd_day IS NOT NULL GROUP BY ALL),
 v AS (SELECT id, wd_day, max(stat_num) AS stat_num FROM o JOIN itemrevstats USING (id, wd_day, rev) GROUP BY ALL),
 s AS (SELECT id, wd_day, stat_num FROM (SELECT *, lag(stat_num) OVER (PARTITION BY id ORDER BY wd_day) AS p FROM v) WHERE p IS DISTINCT FROM stat_num),
 dim AS (SELECT id, stat_num, wd_day AS from_day, lead(wd_day) OVER (PARTITION BY id ORDER BY wd_day) - 1 AS to_day FROM s)"""


_PATH = "CASE snak_place WHEN 'm' THEN 'main' WHEN 'q' THEN 'qualifier' ELSE 'reference_snak' END"
_AT = "CASE snak_place WHEN 'm' THEN claim_no || '.0' WHEN 'q' THEN claim_no || '.1.' || snak_no ELSE claim_no || '.2.' || group_no || '.' || snak_no END"
_UP = "CASE snak_place WHEN 'r' THEN claim_no || '.2.' || group_no ELSE CAST(claim_no AS VARCHAR) END"
_KIND = "CASE WHEN tag IN ('value', 'R', 'S', 'T') THEN 'value' ELSE tag END"
#: The parts of a snak's value as texts.
_PARTS = ", ".join(
    [
        """CASE tag WHEN 'R' THEN 'item' WHEN 'value' THEN json_extract_string(s, '$[3]."entity-type"') END AS entity_kind""",
        """CASE tag WHEN 'R' THEN json_extract_string(s, '$[2]') WHEN 'value' THEN json_extract_string(s, '$[3]."numeric-id"') END AS entity_id""",
        *[f"CASE tag WHEN 'value' THEN json_extract_string(s, '$[3].{x}') END AS {x}" for x in ("amount", "latitude", "longitude")],
        "CASE tag WHEN 'T' THEN json_extract_string(s, '$[3]') WHEN 'value' THEN json_extract_string(s, '$[3].time') END AS time",
        "CASE tag WHEN 'T' THEN json_extract_string(s, '$[2]') WHEN 'value' THEN json_extract_string(s, '$[3].precision') END AS time_precision",
    ]
)


def time_sql(time: str, precision: str) -> str:
    """The literal of a time in SQL."""
    pattern = r"^([+-]?\d+)-(\d\d)-(\d\d)"
    part = lambda k: f"regexp_extract({time}, '{pattern}', {k})"
    year, p = f"try_cast({part(1)} AS BIGINT)", f"try_cast({precision} AS INT)"
    shifted = f"CASE WHEN {year} = 0 OR ({year} < 0 AND {p} >= 9) THEN -1 ELSE {year} END"
    text = f"printf(CASE WHEN {shifted} < 0 THEN '%05d' ELSE '%04d' END, {shifted})"
    return f"""CASE WHEN {time} IS NULL THEN NULL WHEN {year} IS NULL THEN '{times.FALLBACK}' WHEN {p} = 11 THEN '"' || {text} || '-' || {part(2)} || '-' || {part(3)} || '"^^x:date' WHEN {p} = 10 THEN '"' || {text} || '-' || {part(2)} || '"^^x:gYearMonth'
 WHEN {p} <= 9 THEN '"' || {text} || '"^^x:gYear' ELSE '"' || {time} || '"^^x:dateTime' END"""


def _reduced(column: str) -> str:
    pairs = f"(SELECT string_agg(CAST(to_json(j.key) AS VARCHAR) || ':' || CASE WHEN j.key = 'en' THEN CAST(j.value AS VARCHAR) ELSE '1' END, ',' ORDER BY j.key) FROM json_each(cur.{column}) j)"
    return f"CASE WHEN json_valid({column}) AND json_type({column}) = 'OBJECT' THEN '{{' || coalesce({pairs}, '') || '}}' ELSE '{{}}' END"


def oracle_sql() -> dict[str, str]:
    in_place = "(SELECT id, tag, s, vtype, json_extract_string(s, '$[3].latitude') AS latitude FROM decoded)"
    sites = " ".join(f"WHEN '{s}' THEN '{t}'" for s, t in dims.SITE_TAGS.items())
    prefix = "CASE WHEN site = 'commonswiki' THEN 'http://commons.wikimedia.org/wiki/' WHEN site LIKE '%wikivoyage' THEN 'http://' || replace(left(site, -10), '_', '-') || '.wikivoyage.org/wiki/' WHEN site LIKE '%wiki' THEN 'http://' || replace(left(site, -4), '_', '-') || '.wikipedia.org/wiki/' END"
    versions = f"WITH {_P1} SELECT id, stat_num, from_day, to_day, to_day IS NULL AS is_current FROM dim"
    return {
        "p1_found": f"WITH {_P1} SELECT id, from_day FROM dim",
        "p1_versions": versions,
        "p1_merged_in_batches": versions,
        "p2_found": f"WITH {_misfit_sql()} SELECT DISTINCT id, property_id FROM judged WHERE NOT ok",
        "p2_cells": f"""WITH {_apart_sql()} SELECT id, property_id, CASE WHEN dt = 'wikibase-item' THEN CAST(trim(item) AS BIGINT) END AS item_id, CASE WHEN dt = 'quantity' THEN CAST(amount AS DECIMAL(38,9)) END AS amount,
 CASE WHEN dt IN ('string', 'commonsmedia', 'url') THEN json_extract_string(v, '$') END AS text_value, CASE WHEN dt = 'globe-coordinate' THEN CAST(trim(json_extract_string(v, '$.latitude')) AS DOUBLE) END AS latitude, CASE WHEN dt = 'globe-coordinate' THEN CAST(trim(json_extract_string(v, '$.longitude')) AS DOUBLE) END AS longitude,
 CASE WHEN dt = 'time' THEN tm END AS time_value, CASE WHEN dt = 'time' THEN tp END AS time_precision FROM placed WHERE reason IS NULL""",
        "p2_set_apart_places": f"WITH {_apart_sql()} SELECT id, property_id, claim_no, dt AS datatype, reason, CASE WHEN tag IN ('value', 'R', 'S', 'T') THEN 'value' ELSE tag END AS kind, vtype FROM placed WHERE reason IS NOT NULL",
        "p2_balance": f"WITH {claims_cte()} SELECT (SELECT count(*) FROM roots WHERE cl IS NOT NULL) AS n_items, (SELECT count(*) FROM snaks WHERE snak_place = 'm') AS n_values",
        "misfits_by_type": f"WITH {_misfit_sql()} SELECT dt AS declared, count(*) FILTER (ok) AS n_fit, count(*) FILTER (NOT ok) AS n_misfit FROM judged GROUP BY 1",
        "p3_found": "WITH a AS (SELECT CAST(substr(title, 2) AS INT) AS id, max(rev_id) AS rev FROM revision WHERE regexp_full_match(title, 'Q[0-9]+') GROUP BY 1), b AS (SELECT id, max(rev) AS r FROM wb_items GROUP BY 1) SELECT id, rev FROM a LEFT JOIN b USING (id) WHERE r IS NULL OR rev > r",
        "p3_since_success": "WITH s AS (SELECT max(started_at) AS t FROM run_log WHERE lower(trim(run_status)) = 'ok'), r AS (SELECT CAST(substr(title, 2) AS INT) AS id, rev_id, coalesce(delivered_at < (SELECT t FROM s), false) AS before FROM revision WHERE regexp_full_match(title, 'Q[0-9]+')), a AS (SELECT id, max(rev_id) FILTER (before) AS was, max(rev_id) AS rev FROM r GROUP BY 1) SELECT id, rev FROM a WHERE was IS NULL OR rev > was",
        "p5_found": f"WITH {claims_cte()} SELECT id, claim_no, snak_place, group_no, snak_no FROM snaks",
        "p5_claims": f"WITH {claims_cte()} SELECT id, CAST(claim_no AS VARCHAR) AS claim_label, json_extract_string(c, '$.g') AS guid, json_extract_string(c, '$.rank') AS rank FROM claims",
        "p5_references": f"WITH {claims_cte()} SELECT id, claim_no || '.2.' || group_no AS reference_label, CAST(claim_no AS VARCHAR) AS claim_label FROM groups",
        "p5_snaks_decoded": f"WITH {claims_cte()}, {_DECODED} SELECT id, {_PATH} AS path, {_AT} AS snak_label, {_UP} AS parent_label, {_KIND} AS kind, property_id, vtype, {_PARTS} FROM decoded",
        "compact_snaks": f"WITH {claims_cte()}, {_DECODED}, x AS (SELECT id, {_PATH} AS path, {_AT} AS snak_label, {_KIND} AS kind, property_id, vtype, {_PARTS} FROM decoded) SELECT id, path, snak_label, kind, property_id, vtype, entity_id, amount, time, time_precision FROM x",
        "property_roles": f"WITH {claims_cte()}, {_DECODED} SELECT id, property_id, snak_place AS role, count(*) AS n FROM decoded WHERE property_id IS NOT NULL GROUP BY ALL",
        "property_types_with_seed": f"WITH {_SNAKS}, seed AS (SELECT property_id, min(snak_type) AS t FROM full_snaks WHERE tag IN ('value', 'R', 'S', 'T') AND property_id IS NOT NULL AND snak_type IS NOT NULL GROUP BY 1), known AS (SELECT * FROM types WHERE datatype IS NOT NULL) SELECT property_id, coalesce(datatype, t) AS datatype FROM known FULL JOIN seed USING (property_id)",
        "reduced_terms": f"WITH {_current('wb_items')} SELECT id, {_reduced('label')} AS label, {_reduced('description')} AS description FROM cur",
        "p6_found": f"WITH {_MISSING} SELECT DISTINCT src_table, src_id, target_kind, missing_id FROM missing WHERE missing_id IS NOT NULL",
        "p6_impossible": f"WITH r AS ({_refs('wb_items')} UNION ALL {_refs('wb_properties')}) SELECT DISTINCT src_table, src_id, target_kind, digits AS missing_digits FROM r WHERE missing_id IS NULL",
        "p6_by_month": rf"""WITH {_MISSING}, stamps AS (SELECT rev_id, delivered_at, CASE WHEN regexp_full_match(rev_timestamp, '\d{{4}}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(Z|\+00:00)?') THEN try_cast(replace(substr(rev_timestamp, 1, 19), 'T', ' ') AS TIMESTAMP) END AS ts FROM revision),
 months AS (SELECT rev_id AS src_rev, strftime(min(ts) FILTER (ts <= delivered_at), '%Y-%m') AS ref_month FROM stamps GROUP BY 1)
 SELECT src_table, coalesce(ref_month, 'unknown') AS ref_month, target_kind, count(*) AS n_references, count(DISTINCT digits) AS n_missing FROM missing LEFT JOIN months USING (src_rev) GROUP BY ALL""",
        "terms": f"WITH {_TERMS} SELECT id, term_kind, lang, {_TAG} AS tag, text FROM terms WHERE text IS NOT NULL AND {_TAG} IS NOT NULL",
        "term_literals": f"WITH {_TERMS} SELECT id, term_kind, lang, {_LITERAL.format(x='text')} || '@' || {_TAG} AS literal FROM terms WHERE text IS NOT NULL AND {_TAG} IS NOT NULL",
        "language_filter": f"WITH {_TERMS} SELECT lang, term_kind, count(*) AS n_terms, count(text) AS n_texts FROM terms WHERE lang IN ({', '.join(repr(x) for x in LANGUAGES)}) GROUP BY ALL",
        "language_tags": f"WITH {_TERMS} SELECT lang, count(*) AS n, {_TAG} AS tag FROM terms WHERE term_kind <> 'alias' AND {_TAG} IS NOT NULL GROUP BY lang",
        "site_links": f"WITH {_LINKS}, l AS (SELECT id, site, page, {prefix} || {_QUOTE.format(x=chr(114) + 'eplace(page, ' + repr(' ') + ', ' + repr('_') + ')')} AS url, replace(regexp_extract(site, '^(.+?)(wikivoyage|wiki)$', 1), '_', '-') AS lang FROM links) SELECT id, site, page, url, CASE WHEN site <> 'commonswiki' THEN CASE site {sites} ELSE {_SITE_TAG} END END AS language FROM l WHERE url IS NOT NULL",
        "site_filter": f"WITH {_LINKS} SELECT site, count(*) AS n_links, count(DISTINCT id) AS n_items FROM links WHERE site IN ({', '.join(repr(x) for x in SITES)}) AND page IS NOT NULL GROUP BY site",
        "content_metrics": f"WITH {claims_cte()}, n AS (SELECT id, CAST(count(*) AS INT) AS a, CAST(count(*) FILTER (len(refs) > 0) AS INT) AS b, CAST(count(*) FILTER (len(q) > 0) AS INT) AS c FROM parts GROUP BY 1) SELECT id, coalesce(a, 0) AS stat_num, coalesce(b, 0) AS stat_ref_num, coalesce(c, 0) AS stat_q_num, {_SIZE.format(c='label')} AS label_num, {_SIZE.format(c='description')} AS desc_num, {_SIZE.format(c='links')} AS link_num, {_ALIAS} AS alias_num FROM cur LEFT JOIN n USING (id)",
        "property_metrics": f"WITH {_current('wb_properties')} SELECT id, {_SIZE.format(c='label')} AS label_num, {_SIZE.format(c='description')} AS desc_num, {_ALIAS} AS alias_num FROM cur",
        "property_usage": f"WITH {_SNAKS} SELECT property_id, count(*) FILTER (context = 'v') AS main, count(*) FILTER (context = 'q') AS qualifiers, count(*) FILTER (context = 'r') AS \"references\" FROM full_snaks WHERE property_id IS NOT NULL GROUP BY 1",
        "type_stats": f"WITH {_SNAKS} SELECT context, coalesce(snak_type, 'unknown') AS datatype, count(*) AS n_snaks FROM full_snaks GROUP BY ALL",
        "property_type_filter": f"WITH {_SNAKS} SELECT property_id, count(*) AS n_claims, count(DISTINCT id) AS n_items FROM full_snaks WHERE context = 'v' AND snak_type IN ('wikibase-item', 'time') GROUP BY 1",
        "property_types": f"WITH {_TYPED} SELECT property_id, datatype, CASE WHEN datatype = 'string' THEN 'x:string' ELSE 'o:Thing' END AS property_range FROM types",
        "size_totals": f"WITH {_current('wb_items')} SELECT count(*) AS entities, {', '.join(f'CAST(coalesce(sum(length({c})), 0) AS BIGINT) AS {c}_chars' for c in ('claims', 'links', 'label', 'aliases', 'description'))} FROM cur",
        "snak_sequence": f"WITH {claims_cte()}, {_DECODED}, m AS (SELECT id, claim_no, property_id, CASE WHEN row_number() OVER w > 1 AND property_id IS DISTINCT FROM lag(property_id) OVER w THEN 1 ELSE 0 END AS ch FROM decoded WHERE snak_place = 'm' WINDOW w AS (PARTITION BY id ORDER BY claim_no)) SELECT id, claim_no, property_id, CAST(sum(ch) OVER (PARTITION BY id ORDER BY claim_no) AS INT) AS group_no FROM m",
        "time_literals": f"""WITH {claims_cte()}, {_DECODED}, x AS (SELECT CASE tag WHEN 'T' THEN json_extract_string(s, '$[3]') ELSE json_extract_string(s, '$[3].time') END AS time, CASE tag WHEN 'T' THEN json_extract_string(s, '$[2]') ELSE json_extract_string(s, '$[3].precision') END AS time_precision FROM decoded WHERE vtype = 'time')
 SELECT time, time_precision, count(*) AS n, {time_sql('time', 'time_precision')} AS literal FROM x WHERE time IS NOT NULL GROUP BY ALL""",
        "coordinate_literals": f"WITH {claims_cte()}, {_DECODED} SELECT DISTINCT id, latitude, CASE WHEN try_cast(latitude AS DOUBLE) IS NOT NULL THEN '\"' || CASE WHEN regexp_full_match(latitude, '[+-]?\\d+') THEN latitude WHEN try_cast(latitude AS DOUBLE) = 0 THEN '0.0' ELSE CAST(try_cast(latitude AS DOUBLE) AS VARCHAR) END || '\"^^x:float' END AS literal FROM {in_place} WHERE vtype = 'globecoordinate' AND latitude IS NOT NULL",
        "document_literals": f"SELECT doc_id, md5({_LITERAL.format(x='text')}) AS literal_md5, md5({_QUOTE.format(x=chr(114) + 'eplace(text, ' + repr(' ') + ', ' + repr('_') + ')')}) AS quoted_md5 FROM documents WHERE text IS NOT NULL",
        "vocabulary_kinds": "SELECT * FROM (VALUES ('a', 'o:Class', CAST(9 AS BIGINT)), ('a', 'o:ObjectProperty', 3), ('a', 'o:DatatypeProperty', 9), ('a', 'wo:Datatype', 7), ('rs:label', NULL, 28), ('rs:comment', NULL, 28), ('rs:subClassOf', NULL, 2)) v(p, kind, n)",
        "used_datatypes": f"WITH {_TYPED}, i AS (SELECT * FROM (VALUES ('wikibase-item', 'Item'), ('string', 'String'), ('commonsMedia', 'CommonsMedia'), ('time', 'Time'), ('globe-coordinate', 'GlobeCoordinates'), ('url', 'Url'), ('quantity', 'Quantity')) v(datatype, n)) SELECT 'wo:propertyType' || n AS individual, count(property_id) AS n_properties FROM i LEFT JOIN types USING (datatype) GROUP BY 1",
    }


def queries() -> dict:
    names = [n for n in oracle_sql() if n in globals()]
    return {n: globals()[n] for n in [*names, "compact_claims"]}
