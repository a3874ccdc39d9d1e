"""K3: layers that take new columns, and refuse what old files could not hold."""

import pytest
from pyspark.sql import types as T

from conftest import SF001
from ledgerlake.functions import wire
from ledgerlake.operators.silver import to_silver
from ledgerlake.plans.registry import q_stream_evolved
from ledgerlake.sources import files
from ledgerlake.sources.kafka import envelope_from_events
from ledgerlake.sources.tables import read_table
from ledgerlake.streaming import evolution as EV


def rows(df):
    return sorted(map(tuple, df.drop("_batch_id").collect()), key=str)


def test_added_missing_and_widened_columns(spark, scratch):
    make = lambda data, kind: spark.createDataFrame(data, kind)
    EV.write_evolving(make([(1, 2, "x")], "id long, n int, d string"), scratch, 0, ["d"])
    EV.write_evolving(make([(2, 1 << 40, 0.5, "y")], "id long, n long, rate double, d string"), scratch, 1, ["d"])
    EV.write_evolving(make([(3, 7, "x")], "id long, n int, d string"), scratch, 2, ["d"])            # an old producer again
    EV.write_evolving(make([("z", 4, True)], "d string, id long, flag boolean"), scratch, 3, ["d"])
    want = sorted([(1, 2, "x", None, None), (2, 1 << 40, "y", 0.5, None), (3, 7, "x", None, None), (4, None, "z", None, True)], key=str)
    got = EV.read_layer(spark, scratch)
    assert rows(got.select("id", "n", "d", "rate", "flag")) == want
    assert dict(got.dtypes)["n"] == "bigint" and len(files.list_names(spark, f"{scratch}/_schema")) == 3
    # a retried batch changes neither rows nor the log
    EV.write_evolving(make([("z", 4, True)], "d string, id long, flag boolean"), scratch, 3, ["d"])
    assert rows(EV.read_layer(spark, scratch).select("id", "n", "d", "rate", "flag")) == want and len(files.list_names(spark, f"{scratch}/_schema")) == 3
    assert EV.logged(spark, scratch, 0).fieldNames() == ["id", "n", "d"]
    # the log's schema needs no footers: what a merged read finds is the same
    merged = spark.read.option("mergeSchema", "true").schema(got.schema).parquet(scratch)
    assert rows(merged.select("id", "n", "d", "rate", "flag")) == want


@pytest.mark.parametrize("kind", ["id string, n int, d string", "id long, n string, d string", "id int, n double, d string"])
def test_other_changes_are_refused_before_anything_is_written(spark, scratch, kind):
    EV.write_evolving(spark.createDataFrame([(1, 2, "x")], "id long, n int, d string"), scratch, 0, ["d"])
    data = {"id string, n int, d string": [("a", 1, "x")], "id long, n string, d string": [(1, "b", "x")], "id int, n double, d string": [(1, 0.5, "x")]}[kind]
    with pytest.raises(EV.SchemaChangeError):
        EV.write_evolving(spark.createDataFrame(data, kind), scratch, 1, ["d"])
    assert rows(EV.read_layer(spark, scratch).select("id", "n", "d")) == [(1, 2, "x")]


def test_a_column_without_type_and_an_unwritten_layer(spark, scratch):
    with pytest.raises(FileNotFoundError):
        EV.read_layer(spark, scratch)
    assert EV.merged(T.StructType().add("a", T.IntegerType()), T.StructType().add("a", T.NullType())).simpleString() == "struct<a:int>"


def test_a_stream_of_two_versions_equals_the_batch_union(spark):
    got = q_stream_evolved(spark, SF001)
    want = to_silver(wire.accepted(wire.decode(envelope_from_events(read_table(spark, SF001, "events"), False),
                                               {1: wire.TRANSACTION_SCHEMA_JSON}))).drop("_ingested_at")
    both = got.select(*want.columns)
    assert both.exceptAll(want).count() == 0 and want.exceptAll(both).count() == 0
    seen = {(r[0], r[1]): r[2] for r in got.selectExpr("(kafka_offset * 4 + kafka_partition) % 2 AS v", "channel").groupBy("v", "channel").count().collect()}
    assert set(seen) == {(0, None), (1, "web"), (1, "pos")}
