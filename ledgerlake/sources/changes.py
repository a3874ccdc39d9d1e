"""Change-event source (S6) and the change fixture derived from ``orders``.

The connector emits JSON without a schema envelope; a stream of such text is
read with ``from_json`` (``operators.cdc.parse_changes``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.session import spread

ORDER_KEY = ["o_orderkey"]
ORDER_ROW = T.StructType([
    T.StructField("o_orderkey", T.LongType(), True),
    T.StructField("o_custkey", T.LongType(), True),
    T.StructField("o_orderstatus", T.StringType(), True),
    T.StructField("o_totalprice", T.DoubleType(), True),
    T.StructField("o_orderdate", T.DateType(), True),
    T.StructField("o_orderpriority", T.StringType(), True),
])

# Fixed values of the fixture (FIXTURES.md section 6).  Phase p of a key has
# LSN p * PHASE_STRIDE + o_orderkey: snapshot, update 1, update 2, delete,
# re-insert.  Every 7th key's snapshot is delivered twice; keys with
# o_orderkey % 997 = 3 get one extra malformed message.
PHASE_STRIDE = 1_000_000_000
U1_MOD, U2_MOD, D_MOD, C_MOD, DUP_MOD = 5, 10, 25, 50, 7
BAD_MOD, BAD_REM = 997, 3


def read_change_stream(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """S6 on files: one JSON change per line -> ``value`` column."""
    return spark.readStream.format(fmt).load(path)


def _image(status: F.Column, price: F.Column) -> F.Column:
    return F.struct(
        F.col("o_orderkey"), F.col("o_custkey"), status.alias("o_orderstatus"),
        price.alias("o_totalprice"), F.col("o_orderdate").cast("date").alias("o_orderdate"),
        F.col("o_orderpriority"))


def change_messages_from_orders(orders: DataFrame) -> DataFrame:
    """One pass over ``orders``: each row expands (explode) into its phases.

    Columns: ``key`` (JSON), ``value`` (JSON), ``kafka_offset`` (arrival
    position, deliberately not in LSN order).
    """
    k = F.col("o_orderkey")
    status1 = (F.when(F.col("o_orderstatus") == "O", "P")
               .when(F.col("o_orderstatus") == "P", "F").otherwise("O"))
    orig = _image(F.col("o_orderstatus"), F.col("o_totalprice"))
    img1 = _image(status1, F.col("o_totalprice"))
    img2 = _image(status1, F.col("o_totalprice") + F.lit(100.0))
    null_img = F.lit(None).cast(ORDER_ROW)
    odd = (k % 2) == 1   # odd keys carry full before images, even keys none

    def phase(p, op, before, after, when):
        return F.when(when, F.struct(F.lit(p).alias("p"), F.lit(op).alias("op"),
                                     before.alias("before"), after.alias("after")))

    phases = F.array(
        phase(0, "r", null_img, orig, F.lit(True)),
        phase(0, "r", null_img, orig, k % DUP_MOD == 0),
        phase(1, "u", F.when(odd, orig), img1, k % U1_MOD == 0),
        phase(2, "u", F.when(odd, img1), img2, k % U2_MOD == 0),
        phase(3, "d", F.when(odd, img2), null_img, k % D_MOD == 0),
        phase(4, "c", null_img, orig, k % C_MOD == 0),
        phase(9, "x", null_img, null_img, k % BAD_MOD == BAD_REM),
    )
    ex = (spread(orders).select("o_orderkey", F.explode(F.filter(phases, lambda x: x.isNotNull())).alias("e"))
          .select("o_orderkey", "e.*"))
    lsn = F.col("p").cast("long") * PHASE_STRIDE + F.col("o_orderkey")
    value = F.to_json(F.struct(
        F.col("before"), F.col("after"), F.col("op"),
        F.struct(F.lit("source-db").alias("connector"), F.lit("orders").alias("table"),
                 (lsn / 10).cast("long").alias("txId"), lsn.alias("lsn")).alias("source"),
        (F.lit(1_700_000_000_000) + F.col("p")).alias("ts_ms")))
    value = F.when(F.col("op") == "x", F.lit('{"op": "u", "after": {"o_orderkey": ')).otherwise(value)
    # arrival order: a hash of (key, phase), so LSN order is not arrival order
    offset = F.xxhash64(F.col("o_orderkey"), F.col("p"), F.col("op"))
    return ex.select(F.to_json(F.struct(F.col("o_orderkey"))).alias("key"), value.alias("value"),
                     offset.alias("kafka_offset"))
