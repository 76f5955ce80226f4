import random

import pytest
from conftest import rows

from entilake.llm import frequent


def test_frequent_values_against_counting(spark):
    rng = random.Random(5)
    names = ["Hot"] * 4000 + ["hot"] * 300 + ["Hot "] * 61 + [f"u{rng.randint(0, 9000)}" for _ in range(7000)] + [None] * 500 + [""] * 120
    df = spark.createDataFrame([(n, 1) for n in names], "user_name string, h int").repartition(6)
    n = sum(x is not None for x in names)
    for share in (0.005, 0.1):
        got = {r["user_name"]: r for r in frequent.frequent_values(df, "user_name", share).collect()}
        assert set(got) == {x for x in set(names) if x is not None and names.count(x) >= share * n}
        assert all(r["exact_count"] == names.count(k) <= r["approx_count"] for k, r in got.items())


def test_frequent_values_of_nothing(spark):
    for data in ([], [(None,)]):
        assert rows(frequent.frequent_values(spark.createDataFrame(data, "v string"), "v", 0.1)) == []
    assert rows(frequent.frequent_values(spark.createDataFrame([("a",), ("b",)], "v string"), "v", 0.5), "v") == [("a",), ("b",)]


def test_width_follows_the_share():
    assert [1 << frequent.width_bits(s) for s in (0.005, 0.5, 1.0, 0.0002)] == [2048, 32, 16, 65536]
    for share in (0, -1, 1e-5, 2):
        with pytest.raises(ValueError):
            frequent.width_bits(share)


def test_very_long_and_rare_values(spark):
    rng = random.Random(6)
    long_ = "x" * 100_000
    names = [long_] * 30 + ["rare"] * 12 + [f"n{i}" for i in range(20_000)]
    rng.shuffle(names)
    found = frequent.frequent_values(spark.createDataFrame([(n,) for n in names], "v string"), "v", 0.0005)
    assert {r["v"]: r["exact_count"] for r in found.collect()} == {long_: 30, "rare": 12}
