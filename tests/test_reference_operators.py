import bz2
import datetime as dt
import gzip
import json
import os
import random

import pytest
from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from entilake import cli
from entilake.export import kb, turtle
from entilake.export.spec import ExportSpec, preset, result_name
from entilake.functions import days, dims, text, times
from entilake.operators import edits, entities, revisions, snapshots, store
from entilake.operators.registry import Registry
from entilake.session import cut
from entilake.sources import dump
from entilake.sources.claims import claim_list
from entilake.sources.side_inputs import property_types, read_bots, read_max_revision, read_seed_types
from entilake.streaming import ingest


def values(spark, data, expression, kind="string"):
    """Result of an expression on column x for each value."""
    df = spark.createDataFrame([(i, x) for i, x in enumerate(data)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


# Dates


def test_day_index_and_back(spark):
    dates = [dt.date(2012, 1, 1), dt.date(2012, 2, 29), dt.date(2016, 12, 31), dt.date(2011, 12, 31), dt.date(2100, 3, 1)]
    index = values(spark, dates, days.day_index, "date")
    assert index == [(d - dt.date(2012, 1, 1)).days for d in dates]
    assert values(spark, index, days.day_date, "int") == dates
    assert values(spark, [0, 13, 14, -1, -14, -15], days.bucket_end, "int") == [13, 13, 27, -1, -1, -15]


def test_timestamps_in_every_spelling(spark):
    good = dt.datetime(2013, 5, 31, 1, 2, 3)
    data = ["2013-05-31T01:02:03Z", "2013-05-31T01:02:03+00:00", "2013-05-31 01:02:03", "2013-02-30T00:00:00Z", "2013-05-31", "", None, "2013-05-31T25:00:00Z"]
    assert values(spark, data, days.parse_timestamp) == [good] * 3 + [None] * 5
    assert values(spark, ["2013-05-31T99", "2013-5-31", None], days.date_of) == [dt.date(2013, 5, 31), None, None]


# Literals


def test_literals(spark):
    assert values(spark, ['a"b\\c\n', ""], text.string_literal) == ['"a\\"b\\\\c\\n"', '""']
    assert values(spark, ["en-x"], lambda x: text.string_literal(x, F.lit("en"))) == ['"en-x"@en']
    assert values(spark, ["57.946", "0.0001", "12", "0.0", "1.50", "1e-7", "abc", "123456789.1234567"], text.float_text) == ["57.946", "0.0001", "12", "0.0", "1.5", "1e-07", None, "123456789.123"]
    assert values(spark, ["11", "x", "+3"], text.integer_literal) == ['"11"^^x:int', '"+42"^^x:int', '"3"^^x:int']
    assert values(spark, ["+1.50"], text.decimal_literal) == ['"+1.50"^^x:decimal']
    assert values(spark, ["a b/c*d~é:"], text.quote_path) == ["a%20b/c%2Ad%7E%C3%A9%3A"]
    assert values(spark, ["http://a.b/c?d=e f#g"], text.quote_url) == ["http://a.b/c?d=e%20f#g"]
    assert values(spark, ["q1$AB-C", "x$y$z", "none", None], text.guid_suffix) == ["AB-C", "y$z", None, None]
    assert values(spark, ["a,b"], text.csv_name) == ["a<comma>b"]
    assert values(spark, ["&quot;a&amp;"], text.unquote_entities) == ['"a&amp;']


def test_time_literals(spark):
    cases = [("+00000001952-03-11T00:00:00Z", "11", '"1952-03-11"^^x:date'), ("+1952-03-11T00:00:00Z", "10", '"1952-03"^^x:gYearMonth'), ("+00000000052-00-00T00:00:00Z", "7", '"0052"^^x:gYear'), ("-00000000130-00-00T00:00:00Z", "9", '"-0001"^^x:gYear'), ("-00000013000-00-00T00:00:00Z", "7", '"-13000"^^x:gYear'), ("+00000000000-01-01T00:00:00Z", "11", '"-0001-01-01"^^x:date'), ("+2000-01-01T00:00:00Z", "14", '"+2000-01-01T00:00:00Z"^^x:dateTime'), ("unknown", "11", times.FALLBACK), (None, "11", None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t string, p string, want string")
    got = df.select(times.time_literal(F.col("t"), F.col("p")).alias("got"), "want").collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]
    assert values(spark, ["-00000000130-00-00T00:00:00Z"], lambda x: times.time_literal(x, F.lit("9"), "shift")) == ['"-0131"^^x:gYear']


# Dimensions


def test_languages_and_sites(spark):
    assert values(spark, ["en", "pt-br", "simple", "qqx", "zh-yue", "x"], dims.language_tag) == ["en", "pt-BR", "en-x-simple", None, "yue", None]
    assert values(spark, ["be-tarask", "xyz", "foo", "und", "xx", "aa", "sh", "bh", "mo", "nds", "als", None], dims.language_tag) == ["be-tarask", None, None, None, None, None, "sh", "bh", "mo", "nds", "gsw", None]
    assert len(dims.own_tags()) + len(dims.LANGUAGE_TAGS) == 333
    assert values(spark, ["en", "fr"], lambda c: dims.language_tag(c, ["en"])) == ["en", None]
    assert values(spark, ["zh_yuewiki", "commonswiki", "dewikivoyage", "xqbooks"], dims.site_prefix) == ["http://zh-yue.wikipedia.org/wiki/", "http://commons.wikimedia.org/wiki/", "http://de.wikivoyage.org/wiki/", None]
    assert values(spark, ["zh_yuewiki", "commonswiki", "nowiki", "simplewiki", "dewikivoyage", "xqbooks", "aawiki"], dims.site_language) == ["yue", None, "nb", "en", "de", None, "aa"]
    assert dims.vocabulary(spark).count() == 28 and dims.vocabulary_triples(spark).count() == 28 * 3 + 2
    assert values(spark, [" Wikibase-Item", "COMMONSMEDIA", "x"], dims.canonical_datatype) == ["wikibase-item", "commonsMedia", None]


# Edits


def test_edits_with_gaps_and_clashes(spark):
    data = [("B", False, dt.date(2013, 1, 1)), ("B", True, dt.date(2013, 1, 1)), ("x,y", False, dt.date(2013, 1, 3)), (None, False, dt.date(2013, 1, 3)), ("B", False, None)]
    df = spark.createDataFrame(data, "user_name string, is_ip boolean, day date").withColumn("is_bot", F.lit("clash"))
    bots = spark.createDataFrame([("B",), ("B",), (None,)], "bot_name string")
    assert rows(edits.edits_per_day(df.drop("is_bot"), bots, "day")) == [(366, "2013-01-01", 1, 0, 1, 2), (367, "2013-01-02", 0, 0, 0, 0), (368, "2013-01-03", 0, 2, 0, 2)]
    users = edits.edits_per_user(df, bots)
    assert rows(users) == sorted([("", "no", "no", 1), ("B", "no", "yes", 2), ("B", "yes", "yes", 1), ("x<comma>y", "no", "no", 1)], key=repr)
    assert rows(edits.edit_totals(users)) == [(2, 2, 1, 5, 4)]
    assert rows(edits.edits_per_day(df.where("false"), bots, "day")) == []


def test_store_and_snapshots(spark):
    old = spark.createDataFrame([(1, 5, "a"), (2, 5, "b")], "id int, rev int, v string")
    new = spark.createDataFrame([(1, 4, "late"), (2, 6, None), (3, 1, "c")], old.schema)
    merged = store.upsert(old, new, ["id"], "rev")
    assert rows(merged) == [(1, 5, "a"), (2, 6, None), (3, 1, "c")]
    assert rows(store.upsert(merged, new, ["id"], "rev")) == rows(merged)
    assert rows(store.stored_revision(spark.createDataFrame([(1,), (9,)], "id int"), old, ["id"], "rev")) == [(1, 5), (9, -1)]
    store.create_tables(spark, "kb_test")
    store.create_tables(spark, "kb_test")
    assert spark.table("kb_test.items").columns == ["id", "rev", "claims", "links", "label", "aliases", "description"]
    store.drop_tables(spark, "kb_test")
    measures = ", ".join(f"{m} int" for m in snapshots.MEASURES)
    stats = spark.createDataFrame([(1, 10, 13, *[2] * 7), (1, 11, 13, *[3] * 7), (1, 12, 27, *[0] * 7), (2, 13, 27, *[None] * 7)], f"id int, rev int, wd_day int, {measures}")
    total = snapshots.running_totals(snapshots.period_deltas(snapshots.replaced(stats)))
    assert rows(total, "date", "total_items", "changed_items", "statements", "items_with_statements") == [("2012-01-14", 1, 1, 3, 1), ("2012-01-28", 2, 2, 0, 0)]


def test_runs_of_equal_values(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([5, 5, None, None, 5])], "id int, n int, p int")
    assert rows(revisions.consecutive_groups(df, "id", ["n"], "p"), "n", "group_no") == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)]


# Contents


def test_terms_links_and_compact_forms(spark):
    data = [(1, '{"en": "a", "de": 1}', None, '{"en": ["x", 1], "fr": {"0": "y"}, "de": "z"}', '{"enwiki": "A b", "dewiki": {"name": "C", "badges": []}, "x": 3}'), (2, "[]", "", "[]", None)]
    df = spark.createDataFrame(data, "id int, label string, description string, aliases string, links string")
    assert rows(entities.terms(df, ["id"])) == sorted([(1, "label", "en", "a"), (1, "label", "de", None), (1, "alias", "en", "x"), (1, "alias", "en", None), (1, "alias", "fr", "y"), (1, "alias", "de", "z")], key=repr)
    assert rows(entities.site_links(df, ["id"])) == [(1, "dewiki", "C"), (1, "enwiki", "A b")]
    assert rows(entities.counts_of(df, ["id"])) == [(1, 2, 0, 3, 2), (2, 0, 0, 0, 0)]
    assert values(spark, ['{"en": "a\\"", "de": "b"}', None, "[]"], entities.reduced_map) == ['{"de":1,"en":"a\\""}', "{}", "{}"]
    full = [{"m": ["value", 1, "time", {"time": "+1", "precision": 9, "timezone": 0, "before": 1, "after": 2, "calendarmodel": "http://x.example.org/entity/abcdQ3300417"}], "q": [["value", 2, "wikibase-entityid", {"entity-type": "item", "numeric-id": 7}]], "refs": [[["value", 3, "string", "s"]]], "g": "g", "rank": 1}, {"m": ["novalue", 4], "q": [], "refs": [], "g": "h", "rank": 2}]
    claims = spark.createDataFrame([(1, json.dumps(full)), (2, "[1"), (3, None)], "id int, claims string")
    got = dict(entities.compact_claims(claims, ["id"], "claims", claim_list).collect())
    calendar = "http://x.example.org/entity/abcdQ3300417"[35:]
    assert json.loads(got[1]) == [{"m": ["T", 1, 9, "+1", 0, calendar, 2, 1], "q": [["R", 2, 7]], "refs": [[["S", 3, "s"]]]}, {"m": ["novalue", 4], "rank": 2}]
    assert got[2] is None and got[3] is None
    again = dict(entities.compact_claims(spark.createDataFrame([(1, got[1])], "id int, claims string"), ["id"], "claims", claim_list).collect())
    assert again[1] == got[1]


def test_snak_texts():
    assert kb.snak_text(["somevalue", 42]) == "P42 +"
    assert kb.snak_text(["value", 1, "time", {"time": "+1", "precision": 9}]) == 'P1 {"precision": 9, "time": "+1"}'
    assert [kb.snak_text(s) for s in (["novalue", 1], ["R", 1, 2], ["S", 1, "s"], ["value", 1, "quantity", {}], ["value", 1, "wikibase-entityid", {"entity-type": "item", "numeric-id": 2}], None)] == ["P1 -", "P1 Q2", "P1 {s}", "P1 *", "P1 Q2", "P? *"]
    assert kb.claim_text("Q1", {"m": ["R", 1, 2], "q": [["novalue", 3]], "refs": [[["S", 4, "t"]]]}) == "Q1 P1 Q2 (\n  P3 - ,\n  reference {\n    P4 {t} ,\n  },\n ) ."


def test_export_specs():
    assert preset("turtle-links", ExportSpec(sites=("enwiki",))) == ExportSpec(languages=(), sites=("enwiki",), statements=False)
    assert result_name("turtle", "20130531", ExportSpec()) == "turtle-20130531.ttl.gz"
    assert result_name("turtle-stats", "20130531", ExportSpec(languages=("en",))) == "turtle-stats-20130531.ttl.gz"
    assert result_name("kb", "20130531", ExportSpec(sites=())) == "kb-20130531.kb.gz"
    named = result_name("turtle", "20130531", ExportSpec(languages=("en",)))
    assert named == f"turtle-20130531-{ExportSpec(languages=('en',)).fingerprint()}.ttl.gz"
    assert "languages: none" in ExportSpec(languages=()).describe()


def test_triples_of_one_entity(spark):
    claims = [{"m": ["value", 1, "string", "s"], "q": [["somevalue", 2]], "refs": [[["S", 3, "u"]], [["S", 3, "u"]]], "g": "q1$G", "rank": 1}, {"m": ["T", 4, 9, "+1900-00-00T00:00:00Z", 0, "", 0, 0]}, {"m": ["novalue", 5]}, {"m": ["R", 6, 7]}]
    df = spark.createDataFrame([("Q1", True, '{"en": "L", "qqx": "no"}', None, None, json.dumps(claims), '{"enwiki": "A"}')], "title string, is_item boolean, label string, description string, aliases string, claims string, links string")
    types = spark.createDataFrame([(1, "commonsMedia"), (5, "string"), (6, "wikibase-item")], "property_id int, datatype string")
    found = turtle.triples(df, "title", types)
    triple = {(r["s"], r["p"], r["o"]) for r in found.collect()}
    assert ("w:Q1", "rs:label", '"L"@en') in triple and ("w:Q1", "w:P1s", "w:Q1SG") in triple
    assert ("w:Q1SG", "w:P1v", "<http://commons.wikimedia.org/wiki/File:s>") in triple
    assert ("w:Q1SG", "a", "[ a o:Restriction; o:onProperty w:P2q; o:someValuesFrom o:Thing ]") in triple
    assert ("w:Q1S2", "a", "[ a o:Class; o:complementOf [ a o:Restriction; o:onProperty w:P5v; o:someValuesFrom rs:Literal ] ]") in triple
    assert ("w:Q1S3", "w:P6v", "w:Q7") in triple and ("<http://en.wikipedia.org/wiki/A>", "so:about", "w:Q1") in triple
    node = next(o for s, p, o in triple if p == "w:P4v")
    assert (node, "wo:time", '"1900"^^x:gYear') in triple
    assert sum(p == "a" and o == "wo:Reference" for _, p, o in triple) == 1
    counts = turtle.statistics(found).first()
    assert (counts["entities"], counts["statements"], counts["references"], counts["distinct_references"]) == (1, 4, 2, 1)
    assert rows(turtle.usage(found, types)) == sorted([(1, "commonsMedia", 1, 0, 0), (2, None, 0, 1, 0), (3, None, 0, 0, 1), (4, None, 1, 0, 0), (5, "string", 1, 0, 0), (6, "wikibase-item", 1, 0, 0)], key=repr)
    assert rows(turtle.type_usage(turtle.usage(found, types)).where("datatype = 'unknown'")) == [("unknown", 1, 1, 1)]
    declared = rows(turtle.property_declarations(found, types), "s", "o")
    assert ("w:P1v", "o:ObjectProperty") in declared and len([d for d in declared if d[0].startswith("w:P4")]) == 4
    only = turtle.triples(df, "title", types, ExportSpec(property_types=("wikibase-item",), languages=(), sites=(), references=False))
    assert rows(only.where("section = 1"), "s", "p", "o") == [("w:Q1S3", "a", "wo:Statement"), ("w:Q1S3", "w:P6v", "w:Q7")]


def test_seed_types(spark):
    observed = spark.createDataFrame([(1, "time"), (2, None)], "property_id int, datatype string")
    seed = spark.createDataFrame([(1, "url"), (2, "url")], observed.schema)
    assert rows(property_types(observed, seed)) == [(1, "time"), (2, "url")]


# Dumps


def page(title, *revs):
    body = "".join(f'    <revision>\n      <id>{i}</id>\n      <timestamp>{ts}</timestamp>\n      <contributor>{who}</contributor>\n      <text xml:space="preserve">{content}</text>\n    </revision>\n' for i, ts, who, content in revs)
    return f"  <page>\n    <title>{title}</title>\n    <id>1</id>\n{body}  </page>\n"


NAMED, IP, HIDDEN = "<username>Bot &amp; Co</username>", "<ip>1.2.3.4</ip>", ""


def content(label):
    return json.dumps({"label": {"en": label}, "claims": [{"m": ["R", 1, 2]}]}).replace('"', "&quot;")


@pytest.fixture
def data(tmp_path):
    old = page("Q1", (1, "2013-01-01T00:00:00Z", NAMED, content("one")), (2, "2013-01-02T00:00:00Z", IP, content("two"))) + page("Talk:Q1", (90, "2013-01-01T00:00:00Z", NAMED, "x")) + page("Q2", (3, "2013-01-01T00:00:00Z", HIDDEN, content("q2")))
    daily1 = page("Q1", (2, "2013-01-02T00:00:00Z", IP, content("two")), (5, "2013-02-01T00:00:00Z", NAMED, content("five"))) + page("Property:P1", (6, "2013-02-01T00:00:00Z", NAMED, json.dumps({"datatype": "wikibase-item"}).replace('"', "&quot;")))
    daily2 = page("Q2", (7, "2013-02-02T00:00:00Z", NAMED, "")) + page("Qu", (8, "2013-02-02T00:00:00Z", NAMED, "x"))
    for folder, name, text_ in (("dump20130115", "pages-meta-history.xml.bz2", old), ("daily20130201", "pages-meta-hist-incr.xml.bz2", daily1), ("daily20130202", "pages-meta-hist-incr.xml.bz2", daily2), ("daily20130101", "pages-meta-hist-incr.xml.bz2", daily1)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / name).write_bytes(bz2.compress(f"<mediawiki>\n{text_}</mediawiki>\n".encode()))
    return tmp_path


def test_dump_plan_and_revisions(spark, data):
    files = dump.plan_files(spark, str(data))
    assert (files.dump_date, files.dailies, files.latest_date) == ("20130115", ["20130202", "20130201"], "20130202")
    assert dump.plan_files(spark, str(data), max_date="20130201").dailies == ["20130201"]
    assert dump.plan_files(spark, str(data / "nowhere")).paths == []
    all_ = dump.read_dumps(spark, files)
    assert rows(all_, "rev_id", "entity", "user_name", "is_ip", "file_rank") == sorted([(1, "Q1", "Bot & Co", False, 2), (2, "Q1", "1.2.3.4", True, 2), (3, "Q2", "", False, 2), (2, "Q1", "1.2.3.4", True, 1), (5, "Q1", "Bot & Co", False, 1), (6, "P1", "Bot & Co", False, 1), (7, "Q2", "Bot & Co", False, 0)], key=repr)
    assert rows(dump.first_seen(all_), "rev_id", "file_rank") == [(1, 2), (2, 1), (3, 2), (5, 1), (6, 1)]
    assert rows(dump.latest_entities(all_), "entity", "rev_id") == [("P1", 6), ("Q1", 5)]
    assert rows(dump.latest_entities(all_, "global"), "entity", "rev_id") == [("P1", 6), ("Q1", 5), ("Q2", 3)]
    assert rows(dump.latest_entities(all_, "global", "2013-01-02T00:00:00Z"), "entity", "rev_id") == [("Q1", 1), ("Q2", 3)]
    assert rows(dump.latest_entities(all_, max_date="2013-01-20T00:00:00Z"), "entity", "rev_id") == [("Q1", 2)]  # Q2's newest file is empty, P1's too late
    got = {r["entity"]: r for r in dump.entity_contents(dump.latest_entities(all_)).collect()}
    assert json.loads(got["Q1"]["label"]) == {"en": "five"} and got["P1"]["datatype"] == "wikibase-item"
    assert dump.read_dumps(spark, dump.plan_files(spark, str(data / "nowhere"))).count() == 0


@pytest.mark.parametrize("compressed", [False, True])
def test_pages_of_many_revisions_over_many_splits(spark, tmp_path, compressed):
    """A page that is longer than a split, and small ones before and after it."""
    rng = random.Random(1)
    body = lambda i: json.dumps({"label": {"en": f"r{i}"}, "description": {"en": "".join(chr(rng.randint(97, 122)) for _ in range(3000 if compressed else 300))}}).replace('"', "&quot;")
    big = [(i, "2013-01-01T00:00:00Z", NAMED, body(i)) for i in range(1, 1201 if compressed else 401)]
    text_ = page("Q5", (5001, "2013-01-01T00:00:00Z", IP, body(0))) + page("Talk:Q5", (6000, "2013-01-01T00:00:00Z", IP, "no")) + page("Q9", *big) + page("Other", (6001, "2013-01-01T00:00:00Z", IP, "no")) + page("Property:P3", (7000, "2013-01-01T00:00:00Z", IP, body(1)))
    data = f"<mediawiki>\n{text_}</mediawiki>\n".encode()
    at = tmp_path / ("x.xml.bz2" if compressed else "x.xml")
    at.write_bytes(bz2.compress(data, 1) if compressed else data)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(len(at.read_bytes()) // 9))
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        found = dump.read_dump_file(spark, str(at))
        assert dump._records(spark, str(at)).rdd.getNumPartitions() > 5
        got = rows(found, "entity", "rev_id", "is_ip")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == sorted([("Q5", 5001, True), ("P3", 7000, True), *[("Q9", i, False) for i, *_ in big]], key=repr)


def test_damaged_files_and_rejected_revisions(spark, tmp_path):
    good = page("Q1", (1, "2013-01-01T00:00:00Z", NAMED, content("one")), (2, "2013-01-02T00:00:00Z", "<username>a<b></username>", content("two")))
    whole = bz2.compress(f"<mediawiki>\n{good}</mediawiki>\n".encode())
    rng = random.Random(2)
    large = bz2.compress(f"<mediawiki>\n{good}{page('Q2', *[(i, '2013-01-01T00:00:00Z', NAMED, str(rng.random()) * 3000) for i in range(10, 60)])}".encode(), 1)
    for folder, name, data in (("daily20130202", "pages-meta-hist-incr.xml.bz2", whole), ("daily20130203", "pages-meta-hist-incr.xml.bz2", large[: len(large) // 2])):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / name).write_bytes(data)
    rejected = Observation()
    revisions_ = dump.read_dumps(spark, dump.plan_files(spark, str(tmp_path)), rejected)
    got = rows(revisions_, "entity", "rev_id", "file_rank")
    assert ("Q1", 1, 1) in got and ("Q1", 2, 1) not in got and not any(r[1] == 2 for r in got)
    assert rejected.get["n_rejected"] >= 1


def test_command_line(spark, data, tmp_path):
    bots = tmp_path / "bots.json"
    bots.write_text(json.dumps({"query": {"allusers": [{"name": "Bot & Co"}]}}))
    assert rows(read_bots(spark, str(bots))) == [("Bot & Co",)] and rows(read_bots(spark, None)) == []
    out = str(tmp_path / "out")
    per_day, per_user = cli.main(["--data", str(data), "--out", out, "edits", "--bots", str(bots)], spark)
    got = spark.read.csv(per_day, header=True)
    assert got.columns == ["index", "date", "bots", "humans", "anons", "total"] and got.count() == 32
    assert got.agg(F.sum(F.col("total").cast("int"))).first()[0] == 5 == spark.read.csv(per_user, header=True).agg(F.sum(F.col("edits").cast("int"))).first()[0]
    kb_path, ttl = cli.main(["--data", str(data), "--out", out, "export", "--format", "kb", "turtle", "--languages", "en"], spark)
    lines = [r[0] for r in spark.read.text(kb_path).collect()]
    assert "Q1 label {en:five} ." in lines and "P1 type wikibase-item ." in lines and "Q1 P1 Q2 ." in lines
    whole = "\n".join(r[0] for r in spark.read.option("recursiveFileLookup", "true").text(ttl).collect())
    assert "@prefix w:" in whole and "w:P1v\tw:Q2" in whole and "# * 2 entities" in whole and "### Export completed successfully. The End. ###" in whole and "#,1,wikibase-item,1,0,0" in whole and "w:P1s\ta\to:ObjectProperty ." in whole


def test_edits_and_lines_in_one_pass(spark, data, tmp_path):
    out = str(tmp_path / "out")
    paths = cli.main(["--data", str(data), "--out", out, "edits", "--kb", "--debug"], spark)
    assert [p.rsplit("/", 1)[1] for p in paths] == [f"{n}-20130202" for n in ("edits", "edits-by-user", "kb", "debug")]
    lines = [r[0] for r in spark.read.text(paths[2]).collect()]
    assert "Q1 label {en:five} ." in lines and not any(x.startswith("Q2") for x in lines)
    assert [r[0] for r in spark.read.text(paths[2] + "-end").collect()] == ["# 20130202"]
    assert "Q1 (seen before): rev 1 (2013-01-01T00:00:00Z) edited by Bot & Co (IP: false)" in [r[0] for r in spark.read.text(paths[3]).collect()]


def test_history_from_dumps(spark, data, tmp_path):
    out = str(tmp_path / "out")
    args = ["--data", str(data), "--out", out, "history", "--info"]
    stats, props, sums = cli.main(args, spark)
    bucket = lambda day: (dt.date.fromisoformat(day) - dt.date(2012, 1, 1)).days // 14 * 14 + 13
    first, second = bucket("2013-01-02"), bucket("2013-02-01")
    items = spark.read.parquet(f"{stats}/v=1")
    assert rows(items, "id", "rev", "day", "stat_num", "label_num", "link_num") == [(1, 2, first, 1, 1, 0), (1, 5, second, 1, 1, 0), (2, 3, first, 1, 1, 0)]
    info = items.where("rev = 5").first()
    assert json.loads(info["propinfo"]) == {"m": {"P1": 1}} and json.loads(info["langinfo"]) == {"label": ["en"], "description": [], "aliases": {}}
    assert rows(spark.read.parquet(f"{props}/v=1"), "id", "rev", "day", "label_num") == [(1, 6, second, 0)]
    day = lambda b: (dt.date(2012, 1, 1) + dt.timedelta(b)).isoformat()
    text_ = [r[0] for r in spark.read.text(sums).collect()]
    assert text_ == ["date,total items,changed items,statements,statements w refs,statements w qualifiers,labels,descriptions,links,aliases,items with statements", f"{day(first)},2,2,2,0,0,2,0,0,0,2", f"{day(second)},2,1,2,0,0,2,0,0,0,2"]
    again = cli.main(args, spark)
    assert rows(spark.read.parquet(f"{again[0]}/v=2")) == rows(items) and [r[0] for r in spark.read.text(again[2]).collect()] == text_
    plain, _ = snapshots.content_snapshots(dump.first_seen(dump.read_dumps(spark, dump.plan_files(spark, str(data)))))
    assert rows(plain.select("propinfo", "langinfo").distinct()) == [(None, None)]


def test_entities_as_stored(spark, data, tmp_path):
    out = str(tmp_path / "out")
    args = ["--data", str(data), "--out", out, "store"]
    items, properties = cli.main(args, spark)
    got = rows(spark.read.parquet(f"{items}/v=1"))
    assert got == [(1, 5, '[{"m":["R",1,2]}]', None, '{"en":"five"}', "{}", "{}")]
    assert rows(spark.read.parquet(f"{properties}/v=1"), "id", "rev", "claims", "datatype") == [(1, 6, "[]", "wikibase-item")]
    for _ in range(3):
        cli.main(args, spark)
    assert rows(spark.read.parquet(f"{items}/v=4")) == got and sorted(x.name for x in (tmp_path / "out" / "items").iterdir() if x.name.startswith("v=")) == ["v=3", "v=4"]


def test_vocabulary_file(spark, data, tmp_path):
    (path,) = cli.main(["--data", str(data), "--out", str(tmp_path / "out"), "vocabulary"], spark)
    lines = [r[0] for r in spark.read.text(path).collect()]
    assert len(lines) == 9 + 86 and "wo:Item\trs:subClassOf\two:Entity ." in lines and 'wo:globe\trs:label\t"globe" .' in lines


def test_dumps_of_current_revisions(spark, data):
    (data / "dump20130115").rename(data / "curdump20130115")
    (data / "curdump20130115" / "pages-meta-history.xml.bz2").rename(data / "curdump20130115" / "pages-meta-current.xml.bz2")
    files = dump.plan_files(spark, str(data), current=True)
    assert files.dump_date == "20130115" and len(files.paths) == 3 and dump.plan_files(spark, str(data)).dump_date == dump.NO_DUMP
    assert rows(dump.latest_entities(dump.read_dumps(spark, files), "global"), "entity", "rev_id") == [("P1", 6), ("Q1", 5), ("Q2", 3)]


def test_seed_types_and_site_statistics(spark, data, tmp_path):
    seed, stats = tmp_path / "seed.csv", tmp_path / "site_stats.sql.gz"
    seed.write_text("property_id,datatype\n1,Time\n3,commonsmedia\n4,other\n,url\n")
    assert rows(read_seed_types(spark, str(seed))) == [(1, "time"), (3, "commonsMedia")] and read_seed_types(spark, None) is None
    _, types = cli.entities_of(dump.read_dumps(spark, dump.plan_files(spark, str(data))), read_seed_types(spark, str(seed)))
    assert rows(types) == [(1, "wikibase-item"), (3, "commonsMedia")]
    stats.write_bytes(gzip.compress(b"-- dump\nINSERT INTO `site_stats` VALUES (1,77,250123456,3,4);\n"))
    assert read_max_revision(spark, str(stats)) == 250123456 and read_max_revision(spark, str(seed)) is None


def test_stream_equals_batch_and_resumes(spark, data, tmp_path):
    args = (str(data), str(tmp_path / "store"), str(tmp_path / "offsets"), 1)
    (data / "held").mkdir()
    held = data / "daily20130201"
    held.rename(tmp_path / "later")
    ingest.ingest_available(spark, *args)
    assert rows(ingest.latest_state(spark, args[1]), "entity", "rev_id") == [("P1", 6), ("Q1", 5), ("Q2", 3)]  # the earlier daily holds the same pages
    (tmp_path / "later").rename(held)
    ingest.ingest_available(spark, *args)
    ingest.ingest_available(spark, *args)
    batch = dump.latest_entities(dump.read_dumps(spark, dump.plan_files(spark, str(data))), "global")
    assert rows(ingest.latest_state(spark, args[1]), "entity", "rev_id") == rows(batch, "entity", "rev_id")


def test_compacted_store_has_the_same_state(spark, data, tmp_path_factory):
    other = tmp_path_factory.mktemp("store")
    args = (str(data), str(other / "store"), str(other / "offsets"), 1)
    (data / "daily20130201").rename(other / "later")
    ingest.ingest_available(spark, *args)
    before = rows(ingest.latest_state(spark, args[1]), "entity", "rev_id")
    ingest.compact(spark, args[1])
    ingest.compact(spark, args[1])
    assert rows(ingest.latest_state(spark, args[1]), "entity", "rev_id") == before
    (other / "later").rename(data / "daily20130201")
    ingest.ingest_available(spark, *args)
    assert rows(ingest.latest_state(spark, args[1]), "entity", "rev_id") == before
    batches, states = ingest._folders(spark, args[1])
    assert len(batches) == 1 and len(states) == 1
    ingest.compact(spark, args[1])
    assert rows(ingest.latest_state(spark, args[1]), "entity", "rev_id") == before and ingest._folders(spark, args[1])[0] == []


def test_edits_of_a_stream_close_with_the_watermark(spark, tmp_path):
    schema = "rev_id long, ts string, is_ip boolean"
    folder = tmp_path / "in"
    folder.mkdir()
    batches = [
        [(1, "2013-01-01T01:00:00Z", False), (1, "2013-01-01T01:00:00Z", False), (2, "2013-01-01T23:00:00Z", True), (9, "unknown", True)],
        [(1, "2013-01-01T01:00:00Z", False), (3, "2013-01-02T00:00:00Z", False), (4, "2013-01-20T00:00:00Z", True)],
        [(6, "2013-02-20T00:00:00Z", False)],
        [(5, "2013-01-01T05:00:00Z", False), (7, "2013-02-21T00:00:00Z", False)],
    ]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.json(str(folder / f"b{i}"))
    files = sorted(folder.rglob("*.json"), key=lambda f: f.parent.name)
    stream_in = tmp_path / "stream"
    stream_in.mkdir()
    for i, f in enumerate(files):
        f.rename(stream_in / f"{i}.json")
        os.utime(stream_in / f"{i}.json", (1_400_000_000 + i, 1_400_000_000 + i))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(stream_in))
    query = ingest.stream_edits_per_day(stream).writeStream.format("memory").queryName("edits_closed").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    # Each revision once; the late row of the last file came after its day was closed.
    assert rows(spark.table("edits_closed"), "day", "edits", "anons") == [(dt.date(2013, 1, 1), 2, 1), (dt.date(2013, 1, 2), 1, 0), (dt.date(2013, 1, 20), 1, 1)]


def test_consumers_share_a_scan(spark):
    registry = Registry()
    registry.register("n", lambda df: df.agg(F.count("*").alias("n")))
    registry.register("even", lambda df: df.where("id % 2 = 0"))
    with pytest.raises(ValueError):
        registry.register("n", lambda df: df)
    told, closed = [], []
    registry.register("seen", lambda df: df, lambda r: told.append(r.count()) or "five", lambda r: closed.append(rows(r)[0]))
    found = registry.run(spark.range(5))
    assert rows(found["n"]) == [(5,)] and rows(found["even"]) == [(0,), (2,), (4,)] and told == [5] and closed == [(0,)]


def test_checkpoints_cut_the_plan(spark):
    df = cut(spark.range(5).where("id > 1"))
    assert df.count() == 3 and "Filter" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["block_ranks"])
def test_blocks_by_hand(spark, name):
    df = spark.createDataFrame([("Q1", 3, 1), ("Q1", 3, 2), ("Q1", 1, 9), ("Q2", 2, 4)], "entity string, block int, rev_id int")
    assert rows(revisions.with_block_rank(df, "entity", "block"), "entity", "block", "block_rank") == [("Q1", 1, 2), ("Q1", 3, 1), ("Q1", 3, 1), ("Q2", 2, 1)]
    found = revisions.latest_in_first_block(df, "entity", "block", "rev_id", F.col("rev_id") < 4)
    assert rows(found, "entity", "rev_id") == [("Q1", 2)]
