"""Every query of the subpackage against its SQL, on the smallest tables."""

import os

import pytest

from entilake.llm import queries as q

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents languages mix_targets pack_bins revision".split()

pytestmark = pytest.mark.skipif(not os.path.exists(DATA), reason="no test data here")


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        at = f"{DATA}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{at}{'/*' if os.path.isdir(at) else ''}')")
    df = q.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(columns).collect()), key=repr)
    relation = c.execute(q.oracle_sql()[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns and got
    at = [names.index(x) for x in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in relation.fetchall()), key=repr)


def test_found_rows_are_those_of_the_operators(spark):
    run = lambda n: q.queries()[n](spark, DATA).collect()
    packed = run("p7_containers")
    assert {r["doc_id"] for r in run("p7_found")} == {r["doc_id"] for r in packed if r["n_pieces"] > 1}
    segments = {}
    for r in run("p9_segments"):
        if r["confidence"] >= 0.9:
            segments.setdefault(r["doc_id"], set()).add(r["lang_code"])
    label = {r["doc_id"]: r["label_code"] for r in run("p9_labels")}
    want = {(d, c) for d, codes in segments.items() if codes != {label[d]} for c in codes}
    assert {tuple(r) for r in run("p9_found")} == want
    assert {r["source"] for r in run("p8_found")} <= {r["source"] for r in run("p8_shares")}
