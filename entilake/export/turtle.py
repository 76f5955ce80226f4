"""Entities as RDF triples, Turtle text and usage statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entilake.export.spec import ExportSpec
from entilake.functions import dims, text
from entilake.functions.times import time_literal
from entilake.operators.entities import article_url, site_links, terms
from entilake.session import cut
from entilake.sources.claims import SNAK_PATHS, claim_nodes

#: Prefixes of the output, and the vocabulary declared at its head.
PREFIXES = {
    "w": "http://www.wikidata.org/entity/", "wo": "http://www.wikidata.org/ontology#", "r": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rs": "http://www.w3.org/2000/01/rdf-schema#", "o": "http://www.w3.org/2002/07/owl#", "x": "http://www.w3.org/2001/XMLSchema#",
    "so": "http://schema.org/", "sk": "http://www.w3.org/2004/02/skos/core#", "pv": "http://www.w3.org/ns/prov#",
}
DECLARED = {
    "wo:propertyType": "o:ObjectProperty", "wo:globe": "o:ObjectProperty", "wo:latitude": "o:DatatypeProperty", "wo:longitude": "o:DatatypeProperty",
    "wo:altitude": "o:DatatypeProperty", "wo:gcPrecision": "o:DatatypeProperty", "wo:time": "o:DatatypeProperty", "wo:timePrecision": "o:DatatypeProperty",
    "wo:preferredCalendar": "o:ObjectProperty", "pv:wasDerivedFrom": "o:ObjectProperty", "so:about": "o:ObjectProperty", "so:inLanguage": "o:DatatypeProperty",
}
#: Nodes for values, by datatype: name prefix and class (fixed values).
VALUE_NODES = {"time": ("VT", "wo:TimeValue"), "globe-coordinate": ("VC", "wo:GlobeCoordinatesValue"), "quantity": ("QT", "wo:QuantityValue")}
#: Order of the blocks of an entity in the text.
ENTITY, STATEMENT, VALUE, REFERENCE, ARTICLE = range(5)


def header(spark: SparkSession, spec: ExportSpec, generated: datetime | None = None) -> DataFrame:
    """Lines before the first entity. generated: time of the export, now if none is given."""
    when = (generated or datetime.now()).isoformat(sep=" ")
    lines = ["### OWL/RDF Turtle dump", f"# Filter settings ({spec.fingerprint()})", *[f"# - {x}" for x in spec.describe()], f"# Generated on {when}", "###", ""]
    lines += [f"@prefix {p}: <{iri}> ." for p, iri in PREFIXES.items()] + [f"\n{s}\ta\t{o} ." for s, o in DECLARED.items()]
    return spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "ord int, line string")


def snak_types(snaks: DataFrame, types: DataFrame) -> DataFrame:
    """Snaks with datatype and property_range: values by their value type, but strings, which may be files or addresses, and
    snaks without a value by the declared type of the property (types: property_id, datatype)."""
    declared = types.select(F.col("property_id"), F.col("datatype").alias("_declared"))
    by_value = F.try_element_at(dims.literal_map(dims.TYPE_OF_VALUE), F.col("vtype"))
    datatype = F.when(F.col("kind") != "value", F.col("_declared")).when(F.col("vtype") == "string", F.coalesce("_declared", F.lit("string"))).otherwise(by_value)
    joined = snaks.join(declared, "property_id", "left")
    return joined.withColumn("datatype", datatype).withColumn("property_range", dims.property_range(F.coalesce("_declared", datatype))).drop("_declared")


def _field(name: str) -> Column:
    return F.get_json_object("value", f"$.{name}")


def value_key() -> Column:
    """Local name of a value's node: prefix and hash of the value; the same value has the same name everywhere. NULL without
    a value."""
    name = F.when(F.col("datatype") == "time", F.concat_ws("|", "time", "time_precision", F.coalesce(_field("calendarmodel"), F.lit("")))).otherwise(F.col("value"))
    prefix = F.try_element_at(dims.literal_map({t: p for t, (p, _) in VALUE_NODES.items()}), F.col("datatype"))
    return F.when(F.col("value").isNotNull(), F.concat(F.lit("w:"), prefix, text.local_hash(name)))


def snak_object(spec: ExportSpec) -> Column:
    """STRUCT<p, o> of a snak in its context: a value, a restriction for some value, a complement for no value, or the mark
    of an incomplete export where the snak is filtered out or not understood, as a text for a property of quantities."""
    prop = F.concat(F.lit("w:P"), F.col("property_id").cast("string"), F.col("context"))
    value = (
        F.when(F.col("datatype") == "wikibase-item", F.concat(F.lit("w:Q"), F.trim("entity_id")))
        .when(F.col("datatype") == "commonsMedia", F.concat(F.lit("<http://commons.wikimedia.org/wiki/File:"), text.quote_path(text.page_name(F.col("value"))), F.lit(">")))
        .when(F.col("datatype") == "url", F.concat(F.lit("<"), text.quote_url(F.col("value")), F.lit(">")))
        .when(F.col("datatype") == "string", text.string_literal(F.col("value")))
        .when(F.try_element_at(dims.literal_map(dims.TYPE_OF_VALUE), F.col("vtype")) == F.col("datatype"), value_key())
    )
    some = F.concat(F.lit("[ a o:Restriction; o:onProperty "), prop, F.lit("; o:someValuesFrom "), F.col("property_range"), F.lit(" ]"))
    filler = F.when(F.col("property_range") == "o:Thing", "o:Thing").otherwise("rs:Literal")
    none = F.concat(F.lit("[ a o:Class; o:complementOf [ a o:Restriction; o:onProperty "), prop, F.lit("; o:someValuesFrom "), filler, F.lit(" ] ]"))
    found = F.when(F.col("kind") == "value", value).when(F.col("kind") == "somevalue", some).when(F.col("kind") == "novalue", none)
    found = F.when(spec.includes_type(F.col("datatype")), found)
    return F.struct(
        F.when(found.isNotNull() & (F.col("kind") == "value"), prop).otherwise("a").alias("p"),
        F.coalesce(found, F.lit("wo:IncompletelyExported")).alias("o"),
        found.isNotNull().alias("included"),
    )


def statement_snaks(df: DataFrame, title: str, types: DataFrame, spec: ExportSpec) -> DataFrame:
    """Snaks of included statements: title, claim_no, stmt (name), context v, q or r, group_no, snak_no, p, o, included and
    the decoded value. A statement is left out where its main datatype is."""
    nodes = claim_nodes(df, [title], only=["claim", *SNAK_PATHS] if spec.references else ["claim", "main", "qualifier"])
    nodes = nodes.withColumnRenamed(title, "title").withColumn("claim_no", F.get("dewey", F.lit(0)))
    path = F.col("path")
    at = lambda i: F.get("dewey", F.lit(i))
    placed = nodes.withColumn("context", F.when(path == "main", "v").when(path == "qualifier", "q").when(path == "reference_snak", "r"))
    placed = placed.withColumn("group_no", F.when(path == "reference_snak", at(2)).otherwise(0)).withColumn("snak_no", F.when(path == "main", 0).when(path == "qualifier", at(2)).otherwise(at(3)))
    # One shuffle brings the nodes of a claim together: its name and whether it is included go to all its snaks.
    claim = W.partitionBy("title", "claim_no")
    guid = F.max(F.when(path == "claim", text.guid_suffix(F.col("guid")))).over(claim)
    included = F.max(F.when(path == "main", spec.includes_type(F.col("datatype")))).over(claim)
    typed = snak_types(placed, types).withColumn("_g", guid).withColumn("_in", included).where("path <> 'claim' and _in")
    stmt = F.concat(F.lit("w:"), "title", F.lit("S"), F.coalesce("_g", F.col("claim_no").cast("string")))
    return typed.withColumn("stmt", stmt).withColumn("_po", snak_object(spec)).select("*", "_po.*").drop("_po", "_g", "_in")


def _value_triples(snaks: DataFrame) -> DataFrame:
    """Nodes of times, places and quantities, once per statement."""
    nodes = snaks.where("included and kind = 'value'").where(F.col("datatype").isin(*VALUE_NODES))
    nodes = nodes.dropDuplicates(["title", "claim_no", "o"])
    calendar, globe = text.globe_id(_field("calendarmodel")), text.globe_id(_field("globe"))
    item = lambda n: F.concat(F.lit("w:Q"), n.cast("string"))
    rows = lambda *pairs: F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(p).alias("p"), o.alias("o")) for i, (p, o) in enumerate(pairs)])
    triples = (
        F.when(F.col("datatype") == "time", rows(("a", F.lit("wo:TimeValue")), ("wo:time", time_literal(F.col("time"), F.col("time_precision"))), ("wo:timePrecision", text.integer_literal(F.col("time_precision"))), ("wo:preferredCalendar", item(calendar))))
        .when(F.col("datatype") == "globe-coordinate", rows(("a", F.lit("wo:GlobeCoordinatesValue")), ("wo:latitude", text.float_literal(F.col("latitude"))), ("wo:longitude", text.float_literal(F.col("longitude"))), ("wo:altitude", text.float_literal(_field("altitude"))), ("wo:gcPrecision", text.float_literal(_field("precision"))), ("wo:globe", item(globe))))
        .otherwise(rows(("a", F.lit("wo:QuantityValue")), ("wo:numericValue", text.decimal_literal(F.col("amount"))), ("wo:lowerBound", text.decimal_literal(_field("lowerBound"))), ("wo:upperBound", text.decimal_literal(_field("upperBound")))))
    )
    flat = nodes.select("title", F.col("claim_no").alias("block"), F.col("o").alias("s"), F.explode(triples).alias("t"))
    return flat.where("t.o is not null").select("title", F.lit(VALUE).alias("section"), "block", "s", "t.ord", "t.p", "t.o")


def triples(df: DataFrame, title: str, types: DataFrame, spec: ExportSpec | None = None) -> DataFrame:
    """(title, section, block, s, ord, p, o): the triples of entities, in the order of section, block, s and ord within one
    title. df: title (Q1, P1), is_item, label, description, aliases, claims, and links and datatype where there are such; it
    is computed once, into the shared folder."""
    spec = spec or ExportSpec()
    used = [title, "is_item", "label", "description", "aliases", "claims", *[c for c in ("links", "datatype") if c in df.columns]]
    df = cut(df.select(*used))
    base = df.withColumnRenamed(title, "_title")
    s = F.concat(F.lit("w:"), F.col("_title"))
    row = lambda d, section, block, subject, ord_, p, o: d.select(F.col("_title").alias("title"), F.lit(section).alias("section"), block.cast("int").alias("block"), subject.alias("s"), ord_.cast("int").alias("ord"), p.alias("p"), o.alias("o"))
    zero = F.lit(0)
    parts = [row(base, ENTITY, zero, s, zero, F.lit("a"), F.when(F.col("is_item"), "wo:Item").otherwise("wo:Property"))]
    if "datatype" in df.columns:
        kind = F.try_element_at(dims.literal_map(dims.TYPE_INDIVIDUALS), dims.canonical_datatype(F.col("datatype")))
        parts.append(row(base.where(~F.col("is_item")).withColumn("_k", kind).where("_k is not null"), ENTITY, zero, s, F.lit(1), F.lit("wo:propertyType"), F.col("_k")))
    words = terms(base, ["_title"]).where("text is not null").where(spec.includes_language(F.col("lang"))).withColumn("_tag", dims.language_tag(F.col("lang"))).where("_tag is not null")
    predicate = F.when(F.col("term_kind") == "label", "rs:label").when(F.col("term_kind") == "description", "so:description").otherwise("sk:altLabel")
    place = F.when(F.col("term_kind") == "label", 2).when(F.col("term_kind") == "description", 3).otherwise(4)
    parts.append(row(words, ENTITY, zero, s, place, predicate, text.string_literal(F.col("text"), F.col("_tag"))))
    if "links" in df.columns and spec.sites != ():
        links = site_links(base, ["_title"]).where(spec.includes_site(F.col("site"))).withColumn("_url", F.concat(F.lit("<"), article_url(F.col("site"), F.col("page")), F.lit(">"))).where("_url is not null")
        facts = F.array(F.struct(F.lit(0).alias("ord"), F.lit("a").alias("p"), F.lit("so:Article").alias("o")), F.struct(F.lit(1).alias("ord"), F.lit("so:about").alias("p"), s.alias("o")), F.struct(F.lit(2).alias("ord"), F.lit("so:inLanguage").alias("p"), text.string_literal(dims.site_language(F.col("site"))).alias("o")))
        parts.append(row(links.withColumn("_f", F.explode(facts)).where("_f.o is not null"), ARTICLE, zero, F.col("_url"), F.col("_f.ord"), F.col("_f.p"), F.col("_f.o")))
    if spec.statements:
        # Parsed once and kept in the shared folder: seven parts of the result are made of it.
        snaks = cut(statement_snaks(df, title, types, spec).withColumnRenamed("title", "_title"))
        mains = snaks.where("context = 'v'")
        parts.append(row(mains, ENTITY, zero, s, F.col("claim_no") + 5, F.concat(F.lit("w:P"), F.col("property_id").cast("string"), F.lit("s")), F.col("stmt")))
        parts.append(row(mains, STATEMENT, F.col("claim_no"), F.col("stmt"), zero, F.lit("a"), F.lit("wo:Statement")))
        own = snaks.where("context <> 'r'")
        parts.append(row(own, STATEMENT, F.col("claim_no"), F.col("stmt"), F.when(F.col("context") == "v", 1).otherwise(F.col("snak_no") + 2), F.col("p"), F.col("o")))
        parts.append(_value_triples(snaks.withColumnRenamed("_title", "title")))
        if spec.references:
            body = F.array_sort(F.collect_list(F.struct("snak_no", "p", "o")))
            groups = snaks.where("context = 'r'").groupBy("_title", "claim_no", "stmt", "group_no").agg(body.alias("_body"))
            groups = groups.withColumn("_name", F.concat(F.lit("w:R"), text.local_hash(F.to_json("_body"))))
            parts.append(row(groups, STATEMENT, F.col("claim_no"), F.col("stmt"), F.col("group_no") + 1_000_000, F.lit("pv:wasDerivedFrom"), F.col("_name")))
            once = groups.dropDuplicates(["_title", "_name"])
            parts.append(row(once, REFERENCE, zero, F.col("_name"), zero, F.lit("a"), F.lit("wo:Reference")))
            parts.append(row(once.withColumn("_b", F.explode("_body")), REFERENCE, zero, F.col("_name"), F.col("_b.snak_no") + 1, F.col("_b.p"), F.col("_b.o")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p.select(out.columns))
    return out


def property_declarations(found: DataFrame, types: DataFrame) -> DataFrame:
    """(s, p, o) of the declarations of every property used in triples, once each."""
    used = found.select(F.regexp_extract("p", r"^w:P(\d+)[svqr]$", 1).try_cast("int").alias("property_id")).where("property_id is not null").distinct()
    kind = F.when(dims.property_range(F.col("datatype")) == "o:Thing", "o:ObjectProperty").otherwise("o:DatatypeProperty")
    typed = used.join(types.select("property_id", "datatype"), "property_id", "left").withColumn("_k", kind)
    each = typed.select("property_id", "_k", F.explode(F.array(*[F.lit(c) for c in "svrq"])).alias("_c"))
    return each.select(F.concat(F.lit("w:P"), F.col("property_id").cast("string"), "_c").alias("s"), F.lit("a").alias("p"), F.when(F.col("_c") == "s", "o:ObjectProperty").otherwise(F.col("_k")).alias("o"))


def blocks(found: DataFrame) -> DataFrame:
    """(title, section, block, s, text): the Turtle text of each subject; objects of one predicate in a row share it."""
    facts = F.transform(F.array_sort(F.collect_list(F.struct("ord", "p", "o"))), lambda x: F.struct(x["p"].alias("p"), x["o"].alias("o")))
    grouped = found.groupBy("title", "section", "block", "s").agg(facts.alias("_f"))
    part = lambda x, i: F.when((i > 0) & (F.get("_f", i - 1)["p"] == x["p"]), F.concat(F.lit(","), x["o"])).otherwise(F.concat(F.when(i > 0, " ;\n\t").otherwise("\n\t"), x["p"], F.lit("\t"), x["o"]))
    body = F.array_join(F.transform("_f", part), "")
    return grouped.select("title", "section", "block", "s", F.concat(F.lit("\n"), "s", body, F.lit(" .")).alias("text"))


def statistics(found: DataFrame) -> DataFrame:
    """Counts of an export: triples, triples without the opening one of each block, entities, statements, references."""
    opening = (F.col("p") == "a") & (F.col("ord") == 0)
    return found.agg(
        F.count("*").alias("triples_actual"),
        F.count_if(~opening).alias("triples_reported"),
        F.count_if(opening & (F.col("section") == ENTITY)).alias("entities"),
        F.count_if(opening & (F.col("section") == STATEMENT)).alias("statements"),
        F.count_if(F.col("p") == "pv:wasDerivedFrom").alias("references"),
        F.count_if(opening & (F.col("section") == REFERENCE)).alias("distinct_references"),
        F.count_if(opening & (F.col("section") == ARTICLE)).alias("articles"),
    )


def footer(found: DataFrame, types: DataFrame, spec: ExportSpec) -> DataFrame:
    """(ord, line): the lines after the last entity. Totals, uses of datatypes by place, and a list of properties that can be
    read as CSV, most used first. One row per property and datatype is all that meets here."""
    spark = found.sparkSession
    total = statistics(found).first()
    used = cut(usage(found, types))
    declared = property_declarations(found, types).count()
    by_type = sorted(type_usage(used).collect(), key=lambda r: r["datatype"])
    of = lambda place: "{" + ", ".join(f"{r['datatype']}: {r[place]}" for r in by_type if r[place]) + "}"
    lines = ["", "", "### Turtle serialization completed:", f"# * {total['triples_actual']} triples", f"# * {total['entities']} entities", f"# * {declared} additional OWL property declarations", f"# * {total['statements']} statements", f"# * {total['references']} references", f"# * {used.where('datatype is null').count()} properties whose datatype came from their values"]
    lines += [f"# * types of {name} properties: {of(place)}" for name, place in (("main", "main"), ("qualifier", "qualifiers"), ("reference", "references"))]
    if spec.statements:
        lines += ["###", "### The following is a CSV compatible list with property statistics; references count once per entity:", "###", "#,property id,type,use as main property,use in qualifiers,use in references"]
    head = spark.createDataFrame(list(enumerate(lines)), "ord long, line string")
    end = ["###END###"] * spec.statements + ["###", "", "", "### Export completed successfully. The End. ###"]
    tail = spark.createDataFrame([((1 << 62) + i, x) for i, x in enumerate(end)], head.schema)
    if not spec.statements:
        return head.unionByName(tail)
    text_ = F.concat_ws(",", F.lit("#"), F.col("property_id").cast("string"), F.coalesce("datatype", F.lit("unknown")), *[F.col(c).cast("string") for c in ("main", "qualifiers", "references")])
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc("main"), "property_id"))
    return head.unionByName(used.select((place + len(lines)).cast("long").alias("ord"), text_.alias("line"))).unionByName(tail)


def usage(found: DataFrame, types: DataFrame) -> DataFrame:
    """property_id, datatype, main, qualifiers, references: uses in exported snaks, a reference counting once per entity;
    every property met has a row."""
    pattern = r"w:P(\d+)([vqr])\b"
    where = F.when(F.col("p").rlike(r"^w:P\d+[vqr]$"), F.col("p")).when(F.col("o").rlike(r"^\[ a o:(Restriction|Class);"), F.col("o"))
    used = found.select(F.regexp_extract(where, pattern, 1).try_cast("int").alias("property_id"), F.regexp_extract(where, pattern, 2).alias("_c")).where("property_id is not null")
    n = lambda c: F.count_if(F.col("_c") == c)
    counts = used.groupBy("property_id").agg(n("v").alias("main"), n("q").alias("qualifiers"), n("r").alias("references"))
    return counts.join(types.select("property_id", "datatype"), "property_id", "left").select("property_id", "datatype", "main", "qualifiers", "references").orderBy(F.desc("main"), "property_id")


def type_usage(used: DataFrame) -> DataFrame:
    """datatype, main, qualifiers, references over all properties of `usage`."""
    return used.groupBy(F.coalesce("datatype", F.lit("unknown")).alias("datatype")).agg(*[F.sum(c).alias(c) for c in ("main", "qualifiers", "references")])


def write_turtle(found: DataFrame, types: DataFrame, spec: ExportSpec, path: str, generated: datetime | None = None) -> None:
    """A folder of gzip files in name order: header, entities by range of titles, declarations, statistics. The triples are
    computed once, into the shared folder."""
    spark = found.sparkSession
    found = cut(found)
    text_of = lambda df, name: df.write.mode("overwrite").option("compression", "gzip").text(f"{path}/{name}")
    text_of(header(spark, spec, generated).coalesce(1).sortWithinPartitions("ord").select("line"), "0-header")
    text_of(blocks(found).repartitionByRange("title").sortWithinPartitions("title", "section", "block", "s").select("text"), "1-entities")
    declared = property_declarations(found, types)
    text_of(declared.coalesce(1).sortWithinPartitions("s").select(F.concat(F.lit("\n"), "s", F.lit("\t"), "p", F.lit("\t"), "o", F.lit(" ."))), "2-properties")
    text_of(footer(found, types, spec).coalesce(1).sortWithinPartitions("ord").select("line"), "3-statistics")


def write_vocabulary(spark: SparkSession, path: str) -> None:
    """The system vocabulary as one Turtle file with the prefixes of the export."""
    found = dims.vocabulary_triples(spark)
    head = spark.createDataFrame([(f"@prefix {p}: <{iri}> .",) for p, iri in PREFIXES.items()], "line string").withColumn("part", F.lit(0))
    body = found.select(F.concat_ws("\t", "s", "p", F.concat("o", F.lit(" ."))).alias("line"), F.lit(1).alias("part"))
    head.unionByName(body).coalesce(1).sortWithinPartitions("part", "line").select("line").write.mode("overwrite").text(path)
