"""A5 by fingerprints against the grouped count."""

import random

from pyspark.sql import functions as F

from ledgerlake.operators import expectations as EX
from ledgerlake.operators import uniqueness as U


def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, g int, other int").repartition(7)


def same(df, by):
    key = lambda r: tuple(map(str, r))
    a = sorted(map(tuple, EX.uniqueness(df, "key", by).collect()), key=key)
    b = sorted(map(tuple, U.uniqueness_by_fingerprint(df, "key", by).select(*EX.uniqueness(df, "key", by).columns).collect()), key=key)
    if not by and not b:
        return a in ([], [(None, None, None)])
    return a == b


def test_equal_to_the_grouped_count(spark, monkeypatch):
    r = random.Random(6)
    rows = [(f"id{i}", i % 3, i) for i in range(3000)]
    rows += [(f"id{r.randrange(3000)}", r.randrange(3), -1) for _ in range(200)]             # repeats, in the same group or not
    rows += [("hot", 1, i) for i in range(1500)] + [(None, 1, i) for i in range(50)] + [("", None, 1), ("", None, 2), ("x", None, 3)]
    df = frame(spark, rows)
    assert same(df, []) and same(df, ["g"])
    monkeypatch.setattr(U, "RANGE_KEYS", 50)                                              # many ranges
    assert same(df, []) and same(df, ["g"])
    unique = frame(spark, [(f"u{i}", 0, i) for i in range(500)])
    assert same(unique, []) and same(unique, ["g"]) and U.repeated_keys(unique, "key", []).count() == 0
    assert same(frame(spark, [(None, 0, 1)] * 3), ["g"]) and same(unique.limit(0), ["g"])


def test_only_rows_that_may_repeat_are_looked_at_again(spark):
    df = frame(spark, [(f"id{i}", 0, i) for i in range(20_000)] + [(f"id{i}", 0, i) for i in range(40)])
    bits = U.range_bits(20_040, 8)
    found = U.suspects(df, ["key"], bits)
    assert found.count() == 40                                                            # a chance clash has odds of some 1 in 400
    looked_at = df.withColumn("prefix", U._prefix(["key"], bits)).join(found, "prefix", "left_semi")
    assert looked_at.count() == 80
    packed = U.range_bits(10 ** 11, 8)
    assert 10 ** 11 / 2 ** packed <= U.RANGE_KEYS


def test_suite_by_fingerprint_equals_the_suite(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0), (None, 4.0)], "event_id string, amount double")
    rules = [x for x in EX.SUITE if x.column in ("event_id", "amount")]
    plain, quick = EX.run_expectations(df, rules), EX.run_expectations(df, rules, by_fingerprint=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, quick.collect()))
    e7 = quick.filter(F.col("expectation") == "unique").first()
    assert not e7.success and e7.unexpected_count == 2 and e7.nonnull_count == 3
    empty = sorted(map(str, EX.run_expectations(df.limit(0), rules, by_fingerprint=True).collect()))
    assert empty == sorted(map(str, EX.run_expectations(df.limit(0), rules).collect()))
