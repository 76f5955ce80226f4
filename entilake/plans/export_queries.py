"""Exports of the stored entities as tables of triples, declarations, statistics and lines, with SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entilake.export import kb, turtle
from entilake.export.spec import ExportSpec, preset
from entilake.operators.store import stored_entities
from entilake.plans import content_queries as c
from entilake.sources.tables import current_rows, table


def _entities(spark: SparkSession, d: str) -> DataFrame:
    """Items and properties alike: title, is_item and contents."""
    columns = ["claims", "label", "aliases", "description"]
    items = current_rows(table(spark, d, "wb_items", "id", "rev", *columns, "links"), "id", "rev", *columns, "links")
    properties = current_rows(table(spark, d, "wb_properties", "id", "rev", *columns, "datatype"), "id", "rev", *columns, "datatype")
    named = lambda df, letter, is_item: df.withColumn("title", F.concat(F.lit(letter), F.col("id").cast("string"))).withColumn("is_item", F.lit(is_item))
    return named(items, "Q", True).unionByName(named(properties, "P", False), allowMissingColumns=True).drop("id", "rev")


def _triples(spark: SparkSession, d: str, spec: ExportSpec) -> DataFrame:
    return turtle.triples(_entities(spark, d), "title", c.property_types(spark, d), spec)


def triples(spark: SparkSession, d: str) -> DataFrame:
    """All triples of a full export."""
    return _triples(spark, d, ExportSpec()).select("title", "section", "s", "p", "o")


def label_triples(spark: SparkSession, d: str) -> DataFrame:
    return _triples(spark, d, preset("turtle-labels")).where("p in ('rs:label', 'so:description', 'sk:altLabel')").select("s", "p", "o")


def link_triples(spark: SparkSession, d: str) -> DataFrame:
    return _triples(spark, d, preset("turtle-links")).where(F.col("section") == turtle.ARTICLE).select("s", "p", "o")


def item_triples(spark: SparkSession, d: str) -> DataFrame:
    """Main, qualifier and reference values that are items, by property name."""
    found = _triples(spark, d, ExportSpec(languages=(), sites=())).where("o rlike '^w:Q[0-9]+$' and p rlike '^w:P[0-9]+[vqr]$'")
    return found.groupBy("p").agg(F.count("*").alias("n_triples"), F.count_distinct("o").alias("n_objects"))


def turtle_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Turtle text of every subject."""
    return turtle.blocks(_triples(spark, d, ExportSpec())).select("title", "section", "s", "text")


def block_counts(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of the Turtle text by section, with the triples written in them: as many as there are predicates and commas."""
    n = F.regexp_count("text", F.lit(r"\n\t")) + F.regexp_count(F.regexp_replace("text", r'"(\\.|[^"\\])*"|<[^>]*>', ""), F.lit(","))
    return turtle_blocks(spark, d).groupBy("section").agg(F.count("*").alias("n_blocks"), F.sum(n).alias("n_triples"))


def property_declarations(spark: SparkSession, d: str) -> DataFrame:
    return turtle.property_declarations(_triples(spark, d, ExportSpec(languages=(), sites=())), c.property_types(spark, d))


def export_statistics(spark: SparkSession, d: str) -> DataFrame:
    return turtle.statistics(_triples(spark, d, ExportSpec())).select("entities", "statements", "articles", "triples_actual", "triples_reported", "references", "distinct_references")


def export_property_usage(spark: SparkSession, d: str) -> DataFrame:
    """Uses of properties in statements, qualifiers and references as exported."""
    return turtle.usage(_triples(spark, d, ExportSpec(languages=(), sites=())), c.property_types(spark, d))


def export_type_usage(spark: SparkSession, d: str) -> DataFrame:
    """Uses of datatypes as exported."""
    return turtle.type_usage(export_property_usage(spark, d))


def statement_links(spark: SparkSession, d: str) -> DataFrame:
    """Entities and their statements by name."""
    return _statements(spark, d).where("p rlike '^w:P[0-9]+s$'").select("s", "p", "o")


def _statements(spark: SparkSession, d: str) -> DataFrame:
    return _triples(spark, d, ExportSpec(languages=(), sites=()))


def restriction_triples(spark: SparkSession, d: str) -> DataFrame:
    """Restrictions for some value, complements for no value, and marks of incomplete export, with their number."""
    return _statements(spark, d).where("p = 'a' and (o like '[ a o:%' or o = 'wo:IncompletelyExported')").groupBy("o").agg(F.count("*").alias("n"))


def property_type_triples(spark: SparkSession, d: str) -> DataFrame:
    return _triples(spark, d, ExportSpec(languages=(), sites=(), statements=False)).where("p = 'wo:propertyType'").select("s", "p", "o")


def value_facts(spark: SparkSession, d: str) -> DataFrame:
    """Facts about the nodes of times, places and quantities by entity, without the names of the nodes."""
    facts = _statements(spark, d).where((F.col("section") == turtle.VALUE) & (F.col("p") != "a"))
    return facts.groupBy("title", "p", "o").agg(F.count("*").alias("n"))


def typed_statements(spark: SparkSession, d: str) -> DataFrame:
    """Statements by property in an export of items and times only, without references."""
    found = _triples(spark, d, ExportSpec(languages=(), sites=(), property_types=("wikibase-item", "time"), references=False))
    return found.where("p rlike '^w:P[0-9]+s$'").groupBy("p").agg(F.count("*").alias("n_statements"))


def preset_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Entities, statements, articles, references and triples of terms in the export of each format."""
    parts = []
    for name in ("turtle", "turtle-stats", "turtle-links", "turtle-labels"):
        found = _triples(spark, d, preset(name)).where("section <> 2")
        terms = F.count_if(F.col("p").isin("rs:label", "so:description", "sk:altLabel")).alias("n_terms")
        opening = lambda k: F.count_if((F.col("section") == k) & (F.col("ord") == 0) & (F.col("p") == "a"))
        parts.append(found.agg(F.lit(name).alias("preset"), opening(turtle.ENTITY).alias("entities"), opening(turtle.STATEMENT).alias("statements"), opening(turtle.ARTICLE).alias("articles"), F.count_if(F.col("p") == "pv:wasDerivedFrom").alias("n_references"), terms))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stored_items(spark: SparkSession, d: str) -> DataFrame:
    """Items as they are stored: the texts of one language kept; their claims are those of compact_snaks."""
    rows = current_rows(table(spark, d, "wb_items", "id", "rev", "claims", "links", "label", "aliases", "description"), "id", "rev", "claims", "links", "label", "aliases", "description")
    contents = rows.withColumnRenamed("id", "entity_id").withColumn("is_item", F.lit(True)).withColumn("datatype", F.lit(None).cast("string"))
    return stored_entities(contents)[0].select("id", "rev", "links", "label", "aliases", "description")


def kb_entities(spark: SparkSession, d: str) -> DataFrame:
    """Entities with a line in the line format."""
    return kb_lines(spark, d).agg(F.count_distinct("title").alias("entities"))


def known_types(spark: SparkSession, d: str) -> DataFrame:
    """Properties with a known datatype, in the order of their titles."""
    rows = c.property_types(spark, d).where("datatype is not null")
    return rows.select(F.concat(F.lit("P"), F.col("property_id").cast("string")).alias("property_title"), "datatype").orderBy("property_title")


def kb_lines(spark: SparkSession, d: str) -> DataFrame:
    return kb.kb_lines(_entities(spark, d), F.col("title")).select("title", "part", "ord", "line")


def kb_term_lines(spark: SparkSession, d: str) -> DataFrame:
    return kb_lines(spark, d).where("part in (1, 2, 4)").select("title", "line")


def kb_other_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of datatypes, links, and claims with an item, a string (but those that look like JSON), no value or some value and
    nothing else."""
    plain = r'^[QP]\d+ P\d+ (Q\d+|\{([^"{}][^{}]*)?\}|\+|-) \.$'
    return kb_lines(spark, d).where("part in (0, 3)").select("title", "part", "line").unionByName(kb_lines(spark, d).where("part = 5").where(F.col("line").rlike(plain)).select("title", "part", "line"))


def kb_claim_counts(spark: SparkSession, d: str) -> DataFrame:
    """Claims, qualifiers, references and their snaks in the lines of claims."""
    n = lambda pattern, name: F.sum(F.regexp_count("line", F.lit(pattern))).alias(name)
    return kb_lines(spark, d).where("part = 5").agg(F.count("*").alias("claims"), n(r"(?m)^  P\d+ .*,$", "qualifiers"), n(r"(?m)^  reference \{$", "references"), n(r"(?m)^    P\d+ .*,$", "reference_snaks"))


#: For SQL: what a snak's object is made of, so that equal ones have equal objects; NULL where it is not exported.
_OBJECT = """CASE WHEN tag = 'somevalue' AND property_id IS NOT NULL THEN 'some' || property_id WHEN tag = 'novalue' AND property_id IS NOT NULL THEN 'none' || property_id
 WHEN tag IN ('value', 'R', 'S', 'T') THEN CASE snak_type WHEN 'wikibase-item' THEN 'Q' || trim(CASE tag WHEN 'R' THEN json_extract_string(s, '$[2]') ELSE json_extract_string(s, '$[3]."numeric-id"') END)
 WHEN 'commonsMedia' THEN 'F' || replace(txt, ' ', '_') WHEN 'url' THEN 'U' || txt WHEN 'string' THEN 'S' || txt
 WHEN 'time' THEN CASE WHEN vtype = 'time' AND json_type(json_extract(s, '$[3]')) <> 'NULL' THEN 'T' || coalesce(tm, '') || '|' || coalesce(tp, '') || '|' || coalesce(cal, '') END ELSE CASE WHEN snak_type IN ('globe-coordinate', 'quantity') AND vtype <> 'string' AND json_type(json_extract(s, '$[3]')) <> 'NULL' THEN 'V' || CAST(json_extract(s, '$[3]') AS VARCHAR) END END END"""


def _exported(name: str, letter: str) -> str:
    """Snaks of the statements of one table, as exported: title, claim, place and object."""
    number = lambda f: f"CAST(try_cast(json_extract_string(s, '$[3].{f}') AS DOUBLE) IS NOT NULL AS INT)"
    given = lambda f: f"CAST(json_extract_string(s, '$[3].{f}') IS NOT NULL AS INT)"
    item = lambda f: f"CAST(coalesce(regexp_matches(json_extract_string(s, '$[3].{f}'), '/Q[0-9]+$'), false) AS INT)"
    facts = f"CASE snak_type WHEN 'time' THEN 2 + CAST(tm IS NOT NULL AS INT) + {item('calendarmodel')} WHEN 'globe-coordinate' THEN 1 + {' + '.join(number(f) for f in ('latitude', 'longitude', 'altitude', 'precision'))} + {item('globe')} ELSE 1 + {' + '.join(given(f) for f in ('amount', 'lowerBound', 'upperBound'))} END"
    return f"""SELECT *, {_OBJECT} AS object, {facts} AS facts FROM (WITH {c.snaks_sql(name)} SELECT '{letter}' || f.id AS title, f.claim_no, context, group_no, snak_no, tag, vtype, property_id, datatype, snak_type, s, CASE WHEN json_type(json_extract(s, CASE tag WHEN 'S' THEN '$[2]' ELSE '$[3]' END)) NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN json_extract_string(s, CASE tag WHEN 'S' THEN '$[2]' ELSE '$[3]' END) END AS txt,
 CASE tag WHEN 'T' THEN json_extract_string(s, '$[3]') ELSE json_extract_string(s, '$[3].time') END AS tm, CASE tag WHEN 'T' THEN json_extract_string(s, '$[2]') ELSE json_extract_string(s, '$[3].precision') END AS tp, CASE tag WHEN 'value' THEN json_extract_string(s, '$[3].calendarmodel') END AS cal
 FROM full_snaks f JOIN (SELECT DISTINCT id, claim_no FROM snaks WHERE snak_place = 'm') m ON m.id = f.id AND m.claim_no = f.claim_no)"""


def _export_cte() -> str:
    """sn: exported snaks of items and properties; refs: references with what they are made of; once: one of equal ones of
    an entity; used: the snaks that are written, those of references once per entity."""
    return f"""sn AS (({_exported('wb_items', 'Q')}) UNION ALL ({_exported('wb_properties', 'P')})),
 refs AS (SELECT title, claim_no, group_no, string_agg(snak_no || ':' || coalesce(CASE WHEN tag IN ('somevalue', 'novalue') THEN object ELSE property_id || object END, '?'), chr(1) ORDER BY snak_no) AS body, count(*) AS n FROM sn WHERE context = 'r' GROUP BY ALL),
 once AS (SELECT title, body, min((claim_no, group_no)) AS place, any_value(n) AS n FROM refs GROUP BY ALL),
 used AS (SELECT context, property_id, datatype, snak_type, object, tag, s FROM sn WHERE context <> 'r' UNION ALL SELECT context, property_id, datatype, snak_type, object, tag, s FROM sn JOIN once o ON context = 'r' AND o.title = sn.title AND o.place = (sn.claim_no, sn.group_no))"""


def _both(select: str, cte: Callable[[str], str]) -> str:
    """A selection over items and over properties; {t} is the letter of their titles."""
    return " UNION ALL ".join(f"SELECT * FROM (WITH {cte(name)} {select.replace('{t}', letter)})" for name, letter in (("wb_items", "Q"), ("wb_properties", "P")))


def oracle_sql() -> dict[str, str]:
    predicate = "CASE term_kind WHEN 'label' THEN 'rs:label' WHEN 'description' THEN 'so:description' ELSE 'sk:altLabel' END"
    links = c.oracle_sql()["site_links"]
    literal = f"{c._LITERAL.format(x='text')} || '@' || {c._TAG}"
    tagged = f"text IS NOT NULL AND {c._TAG} IS NOT NULL"
    labels = _both(f"SELECT 'w:{{t}}' || id AS s, {predicate} AS p, {literal} AS o FROM terms WHERE {tagged}", c.terms_sql)
    export = _export_cte()
    number = lambda q: f"(SELECT count(*) FROM {q})"
    current = "(SELECT count(DISTINCT id) FROM wb_items) + (SELECT count(DISTINCT id) FROM wb_properties)"
    nodes = "(SELECT title, claim_no, object, any_value(facts) AS facts FROM sn WHERE object IS NOT NULL AND tag IN ('value', 'R', 'S', 'T') AND snak_type IN ('time', 'globe-coordinate', 'quantity') GROUP BY ALL)"
    counts = f"""{export}, l AS ({links}), z AS (SELECT {current} AS entities, {number("sn WHERE context = 'v'")} AS statements, {number('l')} AS articles, {number('refs')} AS refs, {number('once')} AS distinct_refs, {number(nodes)} AS value_nodes,
 (SELECT count(*) FROM types_ WHERE datatype IS NOT NULL) + (SELECT count(*) FROM ({labels})) + {number("sn WHERE context = 'v'")} AS entity_facts, {number("sn WHERE context = 'v'")} + {number("sn WHERE context <> 'r'")} + {number('refs')} AS statement_facts, (SELECT coalesce(sum(facts), 0) FROM {nodes}) AS value_facts, (SELECT coalesce(sum(n + 1), 0) FROM once) AS reference_facts, (SELECT 2 * count(*) + count(language) FROM l) AS article_facts)"""
    types = c._TYPED.replace("types AS", "types_ AS", 1)
    place = lambda p: f"count(*) FILTER (context = '{p}')"
    usage = f"SELECT property_id, any_value(datatype) AS datatype, {place('v')} AS main, {place('q')} AS qualifiers, {place('r')} AS \"references\" FROM used WHERE object IS NOT NULL AND property_id IS NOT NULL GROUP BY 1"
    kind = "CASE WHEN datatype = 'string' AND k <> 's' THEN 'o:DatatypeProperty' ELSE 'o:ObjectProperty' END"
    plain = "CASE WHEN tag = 'R' THEN 'Q' || json_extract_string(s, '$[2]') WHEN tag = 'value' AND vtype = 'wikibase-entityid' AND json_extract_string(s, '$[3].\"entity-type\"') <> 'property' THEN 'Q' || json_extract_string(s, '$[3].\"numeric-id\"') WHEN vtype = 'string' THEN '{' || json_extract_string(s, CASE tag WHEN 'S' THEN '$[2]' ELSE '$[3]' END) || '}' WHEN tag = 'somevalue' THEN '+' WHEN tag = 'novalue' THEN '-' END"
    bare = "JOIN (SELECT id AS i, claim_no AS n FROM parts WHERE coalesce(len(q), 0) = 0 AND coalesce(len(refs), 0) = 0) ON i = id AND n = claim_no WHERE snak_place = 'm'"
    written = "CASE WHEN object IS NULL THEN 'wo:IncompletelyExported' WHEN tag = 'somevalue' THEN '[ a o:Restriction; o:onProperty w:P' || property_id || context || '; o:someValuesFrom ' || CASE WHEN coalesce(datatype, snak_type) = 'string' THEN 'x:string' ELSE 'o:Thing' END || ' ]' WHEN tag = 'novalue' THEN '[ a o:Class; o:complementOf [ a o:Restriction; o:onProperty w:P' || property_id || context || '; o:someValuesFrom ' || CASE WHEN coalesce(datatype, snak_type) = 'string' THEN 'rs:Literal' ELSE 'o:Thing' END || ' ] ]' END"
    whole = lambda x: f"'\"' || coalesce(CAST(try_cast(regexp_extract(trim({x}), '^([+-]?[0-9]+)$', 1) AS BIGINT) AS VARCHAR), '+42') || '\"^^x:int'"
    real = lambda x: f"CASE WHEN try_cast({x} AS DOUBLE) IS NOT NULL THEN '\"' || CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN {x} WHEN try_cast({x} AS DOUBLE) = 0 THEN '0.0' ELSE CAST(try_cast({x} AS DOUBLE) AS VARCHAR) END || '\"^^x:float' END"
    field = lambda f: f"json_extract_string(s, '$[3].{f}')"
    node_item = lambda f: f"CASE WHEN regexp_matches({field(f)}, '/Q[0-9]+$') THEN 'w:Q' || CAST(regexp_extract({field(f)}, '/Q([0-9]+)$', 1) AS BIGINT) END"
    decimal = lambda f: f"'\"' || {field(f)} || '\"^^x:decimal'"
    each = [
        *[("time", p, o) for p, o in (("wo:time", c.time_sql("tm", "tp")), ("wo:timePrecision", whole("tp")), ("wo:preferredCalendar", f"CASE WHEN tag = 'value' THEN {node_item('calendarmodel')} END"))],
        *[("globe-coordinate", p, o) for p, o in (("wo:latitude", real(field("latitude"))), ("wo:longitude", real(field("longitude"))), ("wo:altitude", real(field("altitude"))), ("wo:gcPrecision", real(field("precision"))), ("wo:globe", node_item("globe")))],
        *[("quantity", p, decimal(f)) for p, f in (("wo:numericValue", "amount"), ("wo:lowerBound", "lowerBound"), ("wo:upperBound", "upperBound"))],
    ]
    facts = " UNION ALL ".join(f"SELECT title, '{p}' AS p, {o} AS o FROM nodes WHERE snak_type = '{t}'" for t, p, o in each)
    node_rows = nodes.replace("any_value(facts) AS facts", "any_value(snak_type) AS snak_type, any_value(tag) AS tag, any_value(s) AS s, any_value(tm) AS tm, any_value(tp) AS tp")
    main_rows = number("sn WHERE context = 'v'")
    linked = _both("SELECT '{t}' || id AS title FROM terms WHERE text IS NOT NULL", c.terms_sql) + " UNION ALL " + _both("SELECT '{t}' || id AS title FROM parts", c.claims_cte)
    return {
        "statement_links": _both("SELECT 'w:{t}' || id AS s, 'w:P' || property_id || 's' AS p, 'w:{t}' || id || 'S' || CASE WHEN contains(g, '$') THEN regexp_extract(g, '^[^$]*[$](.*)$', 1, 's') ELSE CAST(claim_no AS VARCHAR) END AS o FROM (SELECT d.id, d.claim_no, property_id, json_extract_string(c, '$.g') AS g FROM decoded d JOIN claims USING (id, claim_no) WHERE snak_place = 'm' AND property_id IS NOT NULL)", lambda name: f"{c.claims_cte(name)}, {c._DECODED}"),
        "restriction_triples": f"WITH {export} SELECT {written} AS o, count(*) AS n FROM used WHERE {written} IS NOT NULL GROUP BY 1",
        "property_type_triples": f"WITH {types} SELECT 'w:P' || property_id AS s, 'wo:propertyType' AS p, 'wo:propertyType' || CASE datatype WHEN 'wikibase-item' THEN 'Item' WHEN 'string' THEN 'String' WHEN 'commonsMedia' THEN 'CommonsMedia' WHEN 'time' THEN 'Time' WHEN 'globe-coordinate' THEN 'GlobeCoordinates' WHEN 'quantity' THEN 'Quantity' ELSE 'Url' END AS o FROM types_ WHERE datatype IS NOT NULL",
        "value_facts": f"WITH {export}, nodes AS {node_rows}, f AS ({facts}) SELECT title, p, o, count(*) AS n FROM f WHERE o IS NOT NULL GROUP BY ALL",
        "typed_statements": f"WITH {export} SELECT 'w:P' || property_id || 's' AS p, count(*) AS n_statements FROM sn WHERE context = 'v' AND snak_type IN ('wikibase-item', 'time') AND property_id IS NOT NULL GROUP BY 1",
        "preset_statistics": f"WITH {export}, l AS ({links}), n AS (SELECT {current} AS e, {main_rows} AS st, {number('l')} AS a, {number('refs')} AS r, {number(f'({labels})')} AS t) SELECT 'turtle' AS preset, e AS entities, st AS statements, a AS articles, r AS n_references, t AS n_terms FROM n UNION ALL SELECT 'turtle-stats', e, st, 0, r, 0 FROM n UNION ALL SELECT 'turtle-links', e, 0, a, 0, 0 FROM n UNION ALL SELECT 'turtle-labels', e, 0, 0, 0, t FROM n",
        "stored_items": f"WITH {c._current('wb_items')} SELECT id, rev, links, {c._reduced('label')} AS label, {c._reduced('aliases')} AS aliases, {c._reduced('description')} AS description FROM cur",
        "kb_entities": f"SELECT count(DISTINCT title) AS entities FROM ({linked} UNION ALL SELECT 'P' || id FROM (WITH {c._current('wb_properties')} SELECT id FROM cur WHERE datatype IS NOT NULL) UNION ALL SELECT 'Q' || id FROM (WITH {c._LINKS} SELECT id FROM links WHERE page IS NOT NULL))",
        "label_triples": labels,
        "link_triples": f"WITH l AS ({links}) SELECT '<' || url || '>' AS s, 'a' AS p, 'so:Article' AS o FROM l UNION ALL SELECT '<' || url || '>', 'so:about', 'w:Q' || id FROM l UNION ALL SELECT '<' || url || '>', 'so:inLanguage', '\"' || language || '\"' FROM l WHERE language IS NOT NULL",
        "item_triples": f"WITH {export} SELECT 'w:P' || property_id || context AS p, count(*) AS n_triples, count(DISTINCT object) AS n_objects FROM used WHERE snak_type = 'wikibase-item' AND tag IN ('R', 'value') AND regexp_full_match(object, 'Q[0-9]+') AND property_id IS NOT NULL GROUP BY 1",
        "export_statistics": f"WITH {types}, {counts} SELECT entities, statements, articles, CAST(entities + entity_facts + statement_facts + value_facts + reference_facts + article_facts AS BIGINT) AS triples_actual, CAST(entity_facts + statement_facts + value_facts + reference_facts + article_facts - articles - statements - value_nodes - distinct_refs AS BIGINT) AS triples_reported, refs AS \"references\", distinct_refs AS distinct_references FROM z",
        "block_counts": f"WITH {types}, {counts} SELECT CAST(unnest(range(5)) AS INT) AS section, unnest([entities, statements, value_nodes, distinct_refs, articles]) AS n_blocks, unnest([CAST(x AS BIGINT) FOR x IN [entities + entity_facts, statement_facts, value_facts, reference_facts, article_facts]]) AS n_triples FROM z",
        "export_property_usage": f"WITH {export} {usage}",
        "export_type_usage": f"WITH {export}, u AS ({usage}) SELECT coalesce(datatype, 'unknown') AS datatype, CAST(sum(main) AS BIGINT) AS main, CAST(sum(qualifiers) AS BIGINT) AS qualifiers, CAST(sum(\"references\") AS BIGINT) AS \"references\" FROM u GROUP BY 1",
        "property_declarations": f"WITH {export}, p AS (SELECT DISTINCT property_id, datatype FROM used WHERE property_id IS NOT NULL AND (context = 'v' OR (object IS NOT NULL AND tag NOT IN ('somevalue', 'novalue')))) SELECT 'w:P' || property_id || k AS s, 'a' AS p, {kind} AS o FROM p, (VALUES ('s'), ('v'), ('r'), ('q')) v(k)",
        "known_types": f"WITH {c._TYPED} SELECT 'P' || property_id AS property_title, datatype FROM types WHERE datatype IS NOT NULL ORDER BY 1",
        "kb_term_lines": _both("SELECT '{t}' || id AS title, '{t}' || id || ' ' || term_kind || ' {' || lang || ':' || text || '} .' AS line FROM terms WHERE text IS NOT NULL", c.terms_sql),
        "kb_other_lines": f"SELECT 'P' || id AS title, CAST(0 AS INT) AS part, 'P' || id || ' type ' || datatype || ' .' AS line FROM (WITH {c._current('wb_properties')} SELECT id, datatype FROM cur WHERE datatype IS NOT NULL) UNION ALL SELECT 'Q' || id, 3, 'Q' || id || ' link {{' || site || ':' || page || '}} .' FROM (WITH {c._LINKS} SELECT * FROM links WHERE page IS NOT NULL) UNION ALL SELECT title, 5, title || ' P' || property_id || ' ' || t || ' .' FROM ("
        + _both(f"SELECT '{{t}}' || id AS title, property_id, {plain} AS t FROM decoded {bare}", lambda name: f"{c.claims_cte(name)}, {c._DECODED}")
        + ") WHERE regexp_full_match(t, '(Q[0-9]+|[{]([^\"{}][^{}]*)?[}]|[+]|-)', 's') AND property_id IS NOT NULL",
        "kb_claim_counts": "SELECT CAST(sum(a) AS BIGINT) AS claims, CAST(sum(b) AS BIGINT) AS qualifiers, CAST(sum(x) AS BIGINT) AS \"references\", CAST(sum(y) AS BIGINT) AS reference_snaks FROM (" + _both("SELECT (SELECT count(*) FROM parts) AS a, (SELECT coalesce(sum(len(q)), 0) FROM parts) AS b, (SELECT count(*) FROM groups) AS x, (SELECT coalesce(sum(len(g)), 0) FROM groups) AS y", c.claims_cte) + ")",
    }


def queries() -> dict:
    names = ("triples", "label_triples", "link_triples", "item_triples", "turtle_blocks", "block_counts", "property_declarations", "export_statistics", "export_property_usage", "export_type_usage", "known_types", "kb_lines", "kb_term_lines", "kb_other_lines", "kb_claim_counts", "kb_entities", "statement_links", "restriction_triples", "property_type_triples", "value_facts", "typed_statements", "preset_statistics", "stored_items")
    return {n: globals()[n] for n in names}
