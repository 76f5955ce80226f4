import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from entilake.operators import history, merkle, orphans, wide
from entilake.operators.shred import with_parent
from entilake.plans import data_queries
from entilake.session import cut
from entilake.sources.claims import CLAIM_TREE, SNAK_PATHS, claim_labels, claim_list, claim_nodes, entity_references
from entilake.sources.tables import current_rows

# History


def versions_by_hand(observed):
    best = {}
    for key, day, rank, value in observed:
        if None not in (key, day, value):
            old = best.get((key, day))
            best[key, day] = max(old, (rank, value)) if old else (rank, value)
    out, last = [], {}
    for key, day in sorted(best):
        value = best[key, day][1]
        if last.get(key) != value:
            out.append((key, value, day))
        last[key] = value
    ends = {}
    full = []
    for key, value, day in reversed(out):
        full.append((key, value, day, ends.get(key)))
        ends[key] = day - 1
    return sorted(full, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_merge_in_batches_equals_one_load(spark, seed):
    rng = random.Random(seed)
    observed = [(rng.randint(1, 4) if rng.random() < 0.6 else 1, rng.randint(0, 30), rng.randint(1, 5), rng.choice([None, 1, 2, 3])) for _ in range(120)]
    schema = "id int, day int, rev int, v int"
    obs = lambda x: history.observations(spark.createDataFrame(x, schema), "id", "day", "rev", ["v"])
    whole = history.merge_versions(None, None, obs(observed), "id", "day", ["v"])
    assert rows(whole, "id", "v", "from_day", "to_day") == versions_by_hand(observed)
    first, second, third = (obs(observed[i : i + 40]) for i in (0, 40, 80))
    dim = history.merge_versions(None, None, first, "id", "day", ["v"])
    dim = history.merge_versions(dim, first, second, "id", "day", ["v"])
    merged = history.merge_versions(dim, history.seen_after(first, second, "id", "day", ["v"]), third, "id", "day", ["v"])
    assert rows(merged, "id", "v", "from_day", "to_day") == versions_by_hand(observed)


def test_late_row_between_confirming_days(spark):
    observed = [(1, 1, 1, 7), (1, 5, 1, 7), (2, 1, 1, 7), (2, 5, 1, 7), (1, 3, 1, 8), (2, 6, 1, 8)]
    obs = lambda x: history.observations(spark.createDataFrame(x, "id int, day int, rev int, v int"), "id", "day", "rev", ["v"])
    first, second = obs(observed[:4]), obs(observed[4:])
    dim = history.merge_versions(None, None, first, "id", "day", ["v"])
    merged = history.merge_versions(dim, first, second, "id", "day", ["v"])
    assert rows(merged, "id", "v", "from_day", "to_day") == versions_by_hand(observed) == [(1, 7, 1, 2), (1, 7, 5, None), (1, 8, 3, 4), (2, 7, 1, 5), (2, 8, 6, None)]
    with pytest.raises(ValueError):
        history.merge_versions(dim, None, second, "id", "day", ["v"])


def test_found_versions_are_loaded_by_the_merge(spark, tmp_path, monkeypatch):
    rows_ = [(1, 1, 1, 7, "2013-01-01"), (1, 2, 5, 7, "2013-01-02"), (1, 3, 3, 8, "2013-02-01")]
    df = spark.createDataFrame(rows_, "id int, rev int, wd_day int, stat_num int, loaded_at string")
    df.withColumn("loaded_at", F.col("loaded_at").cast("timestamp")).write.parquet(f"{tmp_path}/itemrevstats.parquet")
    merge, merged = history.merge_versions, []
    monkeypatch.setattr(history, "merge_versions", lambda dim, *a: merged.append(dim is not None) or merge(dim, *a))
    assert rows(data_queries.p1_found(spark, str(tmp_path))) == [(1, 1), (1, 3), (1, 5)] and merged == [False, True]


def test_history_of_nothing_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "id int, day int, rev int, v int, attr_hash string, from_day int, _best int, last_day int, obs_rank int")
    obs = history.observations(empty, "id", "day", "rev", ["v"])
    assert rows(history.versions(obs, "id", "day", ["v"])) == []
    one = spark.createDataFrame([(1, 5, 1, 7, "x", 9, 3, 1, 1), (1, 5, 1, 7, "y", 8, 2, 1, 1), (None, 5, 1, 7, "x", 1, 1, 1, 1), (2, 5, None, 7, "x", 1, 1, 1, 1)], empty.schema)
    dim = history.versions(history.observations(one, "id", "day", "rev", ["v"]), "id", "day", ["v"])
    assert rows(dim, "id", "v", "from_day", "to_day", "is_current") == [(1, 7, 5, None, True), (2, 7, 5, None, True)]


@pytest.mark.parametrize("kind", ["int", "long", "string"])
def test_ranks_and_ends_of_the_value_range(spark, kind):
    top, low = 2**31 - 1, -(2**31)
    data = [(1, 1, 5, low), (1, 1, 5, top), (1, 1, None, 3), (1, 2, None, 0), (1, 2, -1, -7), (1, 3, top, -1), (1, 3, low, top), (1, 4, None, 9)]
    make = (lambda v: str(v)) if kind == "string" else (lambda v: v)
    df = spark.createDataFrame([(k, d, r, make(v)) for k, d, r, v in data], f"id int, day int, rev int, v {kind}")
    want = {1: make(top), 2: make(-7), 3: make(-1), 4: make(9)}
    obs = history.observations(df, "id", "day", "rev", ["v"])
    assert {r["day"]: r["v"] for r in obs.collect()} == want | ({1: max(make(low), make(top))} if kind == "string" else {})
    assert obs.schema["v"].dataType == df.schema["v"].dataType and obs.where("day = 4").first()[history.RANK] is None
    assert ("HashAggregate" in obs._jdf.queryExecution().toString()) == (kind == "int")


def test_nulls_that_change_places(spark):
    schema = "id int, day int, rev int, a int, b int"
    moved = spark.createDataFrame([(1, 1, 1, None, 5), (1, 2, 1, 5, None), (1, 3, 1, 5, None)], schema)
    dim = history.versions(history.observations(moved, "id", "day", "rev", ["a", "b"]), "id", "day", ["a", "b"])
    assert rows(dim, "a", "b", "from_day", "to_day") == sorted([(None, 5, 1, 1), (5, None, 2, None)], key=repr)


# Claims and shredding

FULL = [{"m": ["value", 1, "string", "a"], "q": [["somevalue", 2], ["value", 3, "wikibase-entityid", {"entity-type": "item", "numeric-id": "7"}]], "refs": [[["novalue", 4]], []], "g": "q1$X", "rank": 1}, {"m": ["R", 5, 9]}]


@pytest.mark.parametrize("text", [json.dumps(FULL), json.dumps(json.dumps(FULL)), json.dumps(FULL).replace('"', "&quot;"), " " + json.dumps({"P1": FULL[:1], "P5": FULL[1:]}) + "\n"])
def test_claims_in_every_form(spark, text):
    assert claim_list(text) == FULL
    df = spark.createDataFrame([(1, text)], "id int, claims string")
    found = rows(claim_labels(df, ["id"]), "path", "dewey")
    assert found == sorted([("claim", [0]), ("claim", [1]), ("main", [0, 0]), ("main", [1, 0]), ("qualifier", [0, 1, 0]), ("qualifier", [0, 1, 1]), ("reference", [0, 2, 0]), ("reference", [0, 2, 1]), ("reference_snak", [0, 2, 0, 0])], key=repr)


@pytest.mark.parametrize("text", [None, "", "  ", "{}", "[]", '"[]"', json.dumps(FULL)[:-5], "[1", "nonsense", "7", "null", "[" * 100_000, '[{"m":NaN}]'])
def test_texts_without_claims(spark, text):
    df = spark.createDataFrame([(1, text)], "id int, claims string")
    assert rows(claim_labels(df, ["id"])) == []


def test_odd_members_and_reading_order(spark):
    claims = '[null, 3, {"m": null, "q": {"b": ["novalue", 1], "a": ["novalue", 2]}, "refs": {"10": [["S", 1, 2.50]], "2": [["S", 1, "x"]]}}, {"m": "text", "q": 4}]'
    df = spark.createDataFrame([(1, claims, "clash", 0)], "id int, claims string, path string, dewey int")
    nodes = claim_nodes(df, ["id"])
    snaks = rows(nodes.where(F.col("path").isin(SNAK_PATHS)), "path", "dewey", "property_id", "value", "is_text")
    assert snaks == sorted([("qualifier", [2, 1, 0], 1, None, None), ("qualifier", [2, 1, 1], 2, None, None), ("reference_snak", [2, 2, 0, 0], 1, "2.50", False), ("reference_snak", [2, 2, 1, 0], 1, "x", True), ("main", [3, 0], None, None, None)], key=repr)
    parents = rows(with_parent(nodes, CLAIM_TREE, "reference_snak"), "dewey", "parent_dewey")
    assert parents == [([2, 2, 0, 0], [2, 2, 0]), ([2, 2, 1, 0], [2, 2, 1])]


def test_very_long_record(spark):
    claims = json.dumps([{"m": ["S", 1, "x" * 100]}] * 30_000)
    df = spark.createDataFrame([(1, claims), (2, "[]")], "id int, claims string")
    assert claim_labels(df, ["id"], only=["main"]).count() == 30_000


def test_current_row_is_the_highest_revision(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 3, None), (1, 3, None), (2, None, "x"), (None, 1, "y")], "id int, rev int, claims string")
    assert rows(current_rows(df, "id", "rev", "claims")) == [(1, 3, None), (2, None, "x")]


# Wide tables

ATTRIBUTES = [(1, "string"), (2, "quantity"), (3, "time"), (4, "globe-coordinate"), (5, "wikibase-item"), (6, "url"), (7, "commonsmedia")]
CASES = [
    (["S", 1, ""], True), (["value", 1, "string", 3], False), (["novalue", 1], True), (["R", 1, 3], False),
    (["value", 2, "quantity", {"amount": "+1.5"}], True), (["value", 2, "quantity", {"amount": 2.5}], True), (["value", 2, "quantity", {"amount": "1,5"}], False), (["value", 2, "quantity", {"amount": None}], False), (["value", 2, "quantity", {}], False),
    (["T", 3, 11, "+00000002000-02-29T00:00:00Z", 0, "", 0, 0], True), (["T", 3, 11, "+00000001900-02-29T00:00:00Z", 0, "", 0, 0], False), (["T", 3, 10, "+00000001900-13-00T00:00:00Z", 0, "", 0, 0], False), (["T", 3, "9", "-5-00-00T00:00:00Z", 0, "", 0, 0], True), (["T", 3, 9, "1900-00-00", 0, "", 0, 0], False), (["T", 3, None, "+1900-01-01", 0, "", 0, 0], False),
    (["value", 4, "globecoordinate", {"latitude": "90", "longitude": -180.0}], True), (["value", 4, "globecoordinate", {"latitude": 90.1, "longitude": 0}], False), (["value", 4, "globecoordinate", {"longitude": 0}], False),
    (["R", 5, "12"], True), (["R", 5, None], False), (["value", 5, "wikibase-entityid", {"entity-type": "property", "numeric-id": 3}], False), (["value", 5, "wikibase-entityid", {"entity-type": "item", "numeric-id": 1.5}], False),
    (["S", 6, "https://a.b/c"], True), (["S", 6, "http://"], False), (["S", 6, "//a.b"], False), (["S", 6, "http:/a.b"], False), (["S", 7, " "], False), (["S", 7, "a.jpg"], True), (["somevalue", 7], True),
]


def test_fits_and_grid(spark):
    data = [(i, json.dumps([{"m": s}])) for i, (s, _) in enumerate(CASES)]
    nodes = claim_nodes(spark.createDataFrame(data, "id int, claims string"), ["id"], only=["main"]).withColumn("claim_no", F.get("dewey", F.lit(0)))
    payload = ["value", "entity_id", "amount", "latitude", "longitude", "time", "time_precision"]
    grid = wide.attribute_grid(nodes, "id", "property_id", "claim_no", ATTRIBUTES, payload)
    assert rows(wide.misfits(grid, "id", ATTRIBUTES), "id") == sorted([(i,) for i, (_, fit) in enumerate(CASES) if not fit], key=repr)
    table = {r["id"]: r for r in wide.wide_table(grid, "id", ATTRIBUTES).collect()}
    assert len(table) == len(CASES) and float(table[4]["p2"]) == 1.5 and table[18]["p5"] == 12 and table[4]["p1"] is None


def test_attributes_read_loosely_and_empty(spark):
    df = spark.createDataFrame([(2, " Time"), (1, "STRING"), (3, "monolingualtext"), (4, None)], "id int, datatype string")
    assert wide.attribute_list(df) == [(1, "string"), (2, "time")]
    none = claim_nodes(spark.createDataFrame([], "id int, claims string"), ["id"], only=["main"]).withColumn("claim_no", F.lit(0))
    assert rows(wide.misfits(wide.attribute_grid(none, "id", "property_id", "claim_no", [], ["value"]), "id", [])) == []


@pytest.fixture
def wide_tables(spark, tmp_path):
    """Items with values of a string (1), of other and missing datatypes (2, 3), of no property at all (9), without claims
    (empty, cut off, missing); the folder."""
    main = lambda *snaks: json.dumps([{"m": s} for s in snaks])
    items = [
        (1, main(["S", 1, "a"], ["S", 1, "b"], ["value", 1, "quantity", {"amount": "1"}], ["S", 2, "c"], ["novalue", 3])),
        (2, main(["S", 9, "d"], "text")),
        (3, "[]"), (4, "{}"), (5, "[{"), (6, None), (7, ""), (8, main(["somevalue", 3])),
    ]
    spark.createDataFrame([(i, 2, c) for i, c in items] + [(3, 1, main(["S", 1, "old"]))], "id int, rev int, claims string").write.parquet(f"{tmp_path}/wb_items.parquet")
    spark.createDataFrame([(1, 1, " String"), (2, 1, "monolingualtext"), (3, 1, None)], "id int, rev int, datatype string").write.parquet(f"{tmp_path}/wb_properties.parquet")
    return str(tmp_path)


def test_no_main_value_is_lost(spark, wide_tables):
    apart = rows(data_queries.p2_set_apart(spark, wide_tables), "id", "claim_no", "property_id", "datatype", "reason", "value")
    assert apart == sorted([(1, 1, 1, "string", "later", "b"), (1, 2, 1, "string", "misfit", '{"amount": "1"}'), (1, 3, 2, None, "no column", "c"), (1, 4, 3, None, "no column", None), (2, 0, 9, None, "no column", "d"), (2, 1, None, None, "no column", None), (8, 0, 3, None, "no column", None)], key=repr)
    assert (1, "a") in rows(data_queries.p2_wide(spark, wide_tables), "id", "p1")
    assert rows(data_queries.p2_balance(spark, wide_tables), "n_items", "n_values") == [(5, 8)]


def test_values_too_large_for_their_column(spark, tmp_path):
    amounts = ["1.5", "1.1234567890", "1.12345678901", "9" * 29, "9" * 30, "0" * 40 + "7", "-0.000000001"]
    main = [["R", 1, "9223372036854775807"], ["R", 1, "9223372036854775808"], ["somevalue", 1], *[["value", 10 + i, "quantity", {"amount": a}] for i, a in enumerate(amounts)], ["novalue", 10], ["value", 10, "quantity", {"amount": "2"}]]
    spark.createDataFrame([(1, 1, json.dumps([{"m": m} for m in main])), (2, 1, json.dumps([{"m": ["somevalue", 1]}, {"m": ["R", 1, 4]}]))], "id int, rev int, claims string").write.parquet(f"{tmp_path}/wb_items.parquet")
    spark.createDataFrame([(1, 1, "wikibase-item"), *[(10 + i, 1, "quantity") for i in range(len(amounts))]], "id int, rev int, datatype string").write.parquet(f"{tmp_path}/wb_properties.parquet")
    cells = {(r["id"], r["property_id"]): r["item_id"] if r["amount"] is None else str(r["amount"]) for r in data_queries.p2_cells(spark, str(tmp_path)).collect()}
    assert cells == {(1, 1): 2**63 - 1, (2, 1): 4, (1, 10): "1.500000000", (1, 11): "1.123456789", (1, 13): "9" * 29 + ".000000000", (1, 15): "7.000000000", (1, 16): "-1E-9"}
    apart = rows(data_queries.p2_set_apart(spark, str(tmp_path)), "id", "property_id", "claim_no", "reason")
    assert apart == sorted([(1, 1, 1, "too large"), (1, 1, 2, "no value"), (1, 12, 5, "too large"), (1, 14, 7, "too large"), (1, 10, 10, "no value"), (1, 10, 11, "later"), (2, 1, 0, "no value")], key=repr)
    assert rows(data_queries.p2_found(spark, str(tmp_path))) == []


def test_wide_table_has_every_item_with_complete_claims(spark, wide_tables):
    assert rows(data_queries.p2_wide(spark, wide_tables), "id", "p1", "n_misfits") == [(1, "a", 1), (2, None, 0), (3, None, 0), (4, None, 0), (8, None, 0)]


# Increments


def test_changes_by_tree(spark):
    rng = random.Random(1)
    old = {k: rng.randint(1, 9) for k in rng.sample(range(100_000), 400)}
    new = dict(old) | {k: 10 for k in rng.sample(sorted(old), 20)} | {k: 1 for k in rng.sample(range(100_000, 2_000_000_000), 10)}
    make = lambda d: merkle.state(spark.createDataFrame([(k, v) for k, v in d.items()] * 2 + [(None, 1), (5_000_000, None)], "id long, rev long"), "id", "rev")
    a, b = cut(make(new)), cut(make(old))
    saved = cut(merkle.tree(b))
    found = merkle.differing_leaves(merkle.tree(a, saved), saved)
    assert rows(merkle.changes(a, b, found)) == sorted(((k, v) for k, v in new.items() if old.get(k, -1) < v), key=repr)
    assert found.count() <= 30 and merkle.differing_leaves(merkle.tree(b, saved), saved).count() == 0
    # The nodes above some of the leaves, made of the saved ones, are those of a whole new tree.
    touched = [k >> merkle.LEAF_BITS for k, v in new.items() if old.get(k) != v]
    some = merkle.tree(a.where((F.shiftright("key", merkle.LEAF_BITS)).isin(touched)), saved)
    assert set(rows(some)) <= set(rows(merkle.tree(a))) and some.where("level = 4").count() >= 1


def test_store_survives_a_failed_run(spark, tmp_path, monkeypatch):
    store = merkle.IncrementalStore(spark, str(tmp_path / "s"))
    df = lambda *x: spark.createDataFrame(list(x), "id long, rev long")
    assert rows(store.run(df((1, 1), (2, 1)), "id", "rev")) == [(1, 1), (2, 1)]
    with monkeypatch.context() as m:
        m.setattr(merkle, "changes", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.run(df((1, 2), (3, 1)), "id", "rev")
    assert rows(store.run(df((1, 2), (3, 1), (2, 1), (2, 0)), "id", "rev")) == [(1, 2), (3, 1)]
    assert rows(store.run(df((1, 2)), "id", "rev")) == [] and len(store.published()) == 3


def test_two_runs_from_one_state_publish_once(spark, tmp_path, monkeypatch):
    store = merkle.IncrementalStore(spark, str(tmp_path / "s"))
    df = lambda *x: spark.createDataFrame(list(x), "id long, rev long")
    store.run(df((1, 1)), "id", "rev")
    other = merkle.IncrementalStore(spark, str(tmp_path / "s"))
    publish = merkle.IncrementalStore._publish

    def late(self, number, manifest):
        monkeypatch.setattr(merkle.IncrementalStore, "_publish", publish)
        assert rows(other.run(df((1, 2)), "id", "rev")) == [(1, 2)]
        publish(self, number, manifest)

    monkeypatch.setattr(merkle.IncrementalStore, "_publish", late)
    with pytest.raises(Exception, match="exist"):
        store.run(df((1, 3)), "id", "rev")
    assert rows(store.run(df((1, 3)), "id", "rev")) == [(1, 3)] and len(store.published()) == 3


def test_store_writes_changes_and_is_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "COMPACT_AFTER", 3)
    monkeypatch.setattr(merkle, "KEEP_RUNS", 2)
    store = merkle.IncrementalStore(spark, str(tmp_path / "s"))
    rng, held = random.Random(3), {}
    for i in range(6):
        batch = [(rng.randint(0, 3000), rng.randint(1, 4)) for _ in range(60 if i else 2000)]
        want = {k: max(v for q, v in batch if q == k) for k, _ in batch}
        want = {k: v for k, v in want.items() if v > held.get(k, -1)}
        out = store.run(spark.createDataFrame(batch, "id long, rev long"), "id", "rev")
        assert dict(map(tuple, out.collect())) == want
        held |= want
        last = store._names("runs")[-1]
        if i:
            assert spark.read.parquet(store._folder(last, "changed")).where("level = 0").count() <= len(want)
    records, nodes, manifest = store.saved()
    assert dict(map(tuple, records.collect())) == held and len(store._names("runs")) <= 6 and store._names("runs")[0].startswith("0000000004")
    assert rows(merkle.tree(records), "level", "node", "n", "digest") == rows(nodes, "level", "node", "n", "digest")


# Orphans


@pytest.mark.parametrize("most", [256, 1])
def test_orphans_with_a_hot_key(spark, monkeypatch, most):
    rng = random.Random(3)
    kinds, far = ["item", "property"], [2**63 - 1, -(2**63), 2**62, 0]
    refs = [(i, rng.choice(kinds), 7 if i % 3 == 0 else rng.randint(0, 50_000), i % 2 == 0) for i in range(6000)] + [(9, "item", None, True), (9, None, 4, True), (1, "item", 4, False), (1, "item", 4, False), *[(2, k, f, True) for k in kinds for f in far]]
    parents = [("item", k) for k in rng.sample(range(50_000), 20_000) if k != 4] + [("property", k) for k in range(0, 50_000, 3)] + [("item", 7), ("item", 7), ("item", None), (None, 3), ("item", far[0]), ("property", far[1])]
    monkeypatch.setattr(orphans, "MOST_SPLIT", most)
    monkeypatch.setattr(orphans, "max", lambda a, b: b, raising=False)
    found = orphans.find_orphans(spark.createDataFrame(refs, "src int, kind string, target long, flag boolean"), spark.createDataFrame(parents, "kind string, target long"), "kind", "target")
    have = set(parents)
    assert rows(found) == sorted((r for r in refs if r[1] is not None and r[2] is not None and r[1:3] not in have), key=repr)


def test_orphans_of_empty_tables(spark):
    refs = spark.createDataFrame([(1, "item", 5)], "src int, kind string, target long")
    none = spark.createDataFrame([], refs.schema)
    assert rows(orphans.find_orphans(refs, none.drop("src"), "kind", "target")) == [(1, "item", 5)]
    assert rows(orphans.find_orphans(none, refs.drop("src"), "kind", "target")) == []


def test_references_to_impossible_ids(spark, tmp_path):
    far = ["9223372036854775807", "9223372036854775808", "1" + "0" * 40]
    claims = json.dumps([{"m": ["R", 1, x]} for x in [*far, "007", " 2 ", "-1", 3.0]])
    spark.createDataFrame([(1, 1, claims), (7, 1, "[]")], "id int, rev int, claims string").write.parquet(f"{tmp_path}/wb_items.parquet")
    spark.createDataFrame([], "id int, rev int, claims string").write.parquet(f"{tmp_path}/wb_properties.parquet")
    spark.createDataFrame([], "log_id long, entity_id int, log_action string, logged_at timestamp").write.parquet(f"{tmp_path}/deletion_log.parquet")
    assert rows(data_queries.p6_found(spark, str(tmp_path))) == sorted([("wb_items", 1, "item", 2**63 - 1), ("wb_items", 1, "item", 2)], key=repr)
    assert rows(data_queries.p6_impossible(spark, str(tmp_path)), "src_id", "missing_digits") == sorted([(1, far[1]), (1, far[2])], key=repr)


def test_entity_references(spark):
    claims = [{"m": ["R", 1, " 7 "], "q": [["value", 2, "wikibase-entityid", {"entity-type": "property", "numeric-id": 3}]]}, {"m": ["value", 1, "string", "Q5"]}, {"m": ["somevalue", 1]}]
    df = spark.createDataFrame([(1, json.dumps(claims))], "id int, claims string")
    assert rows(entity_references(df, ["id"]), "entity_kind", "entity_id") == [("item", " 7 "), ("property", "3")]
