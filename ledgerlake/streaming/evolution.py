"""K3: additive schema evolution on write, with a schema log beside each layer.

    layer/_schema/version-00000.json      the layer's columns, from this version on

A batch whose columns the log knows is written in the log's types, columns it lacks as
typed NULLs.  New columns are appended to the log (as nullable) before the batch is
written; an integer may become a long and a float a double.  Any other change of a
type is refused before anything is written: old files could no longer be read.

A layer is read with the log's schema, so files of older versions give typed NULLs for
what they lack, and no file footer is opened to find out (``mergeSchema`` opens all).
Retrying a batch finds its columns in the log and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sources import files

WIDER = {("int", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("float", "double")}


class SchemaChangeError(ValueError):
    """A batch's types do not fit what the layer holds."""


def logged(spark: SparkSession, path: str, version: int | None = None) -> T.StructType | None:
    """The layer's schema (as of a version); None before its first batch."""
    known = [n for n in files.list_names(spark, f"{path}/_schema") if n.startswith("version-")]
    known = known if version is None else known[:version + 1]
    return T.StructType.fromJson(files.read_json(spark, f"{path}/_schema/{known[-1]}")["schema"]) if known else None


def merged(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """``old`` with what ``new`` adds; raises where a type does not fit."""
    if old is None:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in new.fields])
    known, out, wrong = {f.name: f for f in new.fields}, [], []
    for f in old.fields:
        kind = known[f.name].dataType if f.name in known else f.dataType
        pair = (f.dataType.simpleString(), kind.simpleString())
        if isinstance(kind, T.NullType) or pair[0] == pair[1] or pair[::-1] in WIDER:
            kind = f.dataType                        # the batch is written in the wider type
        elif pair not in WIDER:
            wrong.append(f"{f.name}: {pair[0]} cannot become {pair[1]}")
        out.append(T.StructField(f.name, kind, True))
    if wrong:
        raise SchemaChangeError("; ".join(wrong))
    out += [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name not in {o.name for o in old.fields}]
    return T.StructType(out)


def evolve(spark: SparkSession, path: str, new: T.StructType, batch_id: int) -> T.StructType:
    """The schema to write a batch in; logs it if the batch adds to it."""
    old = logged(spark, path)
    now = merged(old, new)
    if now != old:
        n = len([x for x in files.list_names(spark, f"{path}/_schema") if x.startswith("version-")])
        files.write_json(spark, f"{path}/_schema/version-{n:05d}.json", {"batch_id": int(batch_id), "schema": now.jsonValue()})
    return now


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``, in its types and order."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_evolving(df: DataFrame, path: str, batch_id: int, by: list[str]) -> None:
    """One micro-batch into an evolving layer; a retry overwrites exactly it."""
    schema = evolve(df.sparkSession, path, df.schema, batch_id)
    (aligned(df, schema).withColumn("_batch_id", F.lit(int(batch_id)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by, "_batch_id").parquet(path))


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A layer across its versions, in the types of the last."""
    schema = logged(spark, path)
    if schema is None:
        raise FileNotFoundError(f"no schema log beside {path}")
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("_batch_id", T.IntegerType())])).parquet(path)
