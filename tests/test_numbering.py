"""Row numbers and first-n selections, with one group holding a large share of the rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cohortflow.operators.numbering import first_by_digest, group_bound, group_sizes, number_rows


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 distinct rows; a third belong to key "hot", some have no key."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        rows.append((key, rng.randrange(50), f"r{i:05d}"))
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, place int, name string").repartition(7)


def brute_force(rows, keyed=True):
    groups = {}
    for key, place, name in rows:
        groups.setdefault(key if keyed else 0, []).append((place, name))
    numbers = {}
    for group in groups.values():
        for number, (_, name) in enumerate(sorted(group), start=1):
            numbers[name] = number
    return numbers


@pytest.mark.parametrize("settle", [False, True])
@pytest.mark.parametrize("limit", [0, 500, 10_000])
def test_numbers_per_key(spark, skewed, limit, settle):
    df = frame(spark, skewed)
    numbered = number_rows(df, ["key"], ["place", "name"], "n", settle=settle, limit=limit)
    assert numbered.columns == ["key", "place", "name", "n"]
    assert dict(numbered.schema.fields[-1].jsonValue())["type"] == "long"
    assert {r.name: r.n for r in numbered.collect()} == brute_force(skewed)


@pytest.mark.parametrize("limit", [0, 10_000])
def test_numbers_without_key(spark, skewed, limit):
    rows = [(k or "none", p, n) for k, p, n in skewed]
    numbered = number_rows(frame(spark, rows), [], ["place", "name"], "n", limit=limit)
    assert {r.name: r.n for r in numbered.collect()} == brute_force(rows, keyed=False)


def test_hot_key_is_spread_over_slices(spark, skewed):
    """The sliced way leaves no task with the whole hot key."""
    numbered = number_rows(frame(spark, skewed), ["key"], ["place", "name"], "n", limit=0)
    plan = numbered._jdf.queryExecution().analyzed().toString()
    assert "row_number" not in plan
    assert numbered.filter("key = 'hot'").agg(F.max("n")).first()[0] == 1000


@pytest.mark.parametrize("bucket_rows", [3, 100, 50_000])
@pytest.mark.parametrize("n", [1, 17, 400, 5000])
def test_first_by_digest(spark, n, bucket_rows):
    rows = [("hot" if i % 3 else f"k{i % 7}", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "key string, id int")
    taken = first_by_digest(df, ["key"], F.md5(F.col("id").cast("string")), n, bucket_rows)
    groups = {}
    for key, i in rows:
        groups.setdefault(key, []).append((hashlib.md5(str(i).encode()).hexdigest(), i))
    expected = {(key, i) for key, ids in groups.items() for _, i in sorted(ids)[:n]}
    found = [(r.key, r.id) for r in taken.collect()]
    assert len(found) == len(expected) and set(found) == expected


def test_no_group_exceeds_its_bound(spark):
    rows = [(k % 7 or None, "x" if k % 3 else None) for k in range(500)]
    df = spark.createDataFrame(rows, "a long, b string")
    largest, total = group_sizes(df, ["a", "b"])
    assert largest <= group_bound(df, ["a", "b"]) <= total
    assert group_bound(df.limit(0), ["a"]) == 0
