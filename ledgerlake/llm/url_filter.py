"""URL filter: a blocked Bloom filter of the listed keys passes possible hits
to an exact hash join that removes the false positives.

Two lists are looked up.  *Rules* (host, path, verdict) fit their host and all
its subdomains where the url's path starts with the rule's path; the longest
rule wins (then, between equal lengths, the first in text order; a rule listed
twice with both verdicts blocks).  *Listed urls* are blocked in canonical form.
A url that no rule fits has the listed urls' verdict: ``block`` if its
canonical url is listed, else ``allow``.

Every url has a few lookup keys: its canonical url, and each of its host
suffixes joined with each path prefix as long as some rule's path.  The filter
is a table of 512-bit blocks; one equi-join brings the key's block, one bit
test in each of its eight words keeps possible hits.

Defined results: a null url, or one without ``://``, has empty host and path,
no rule and verdict ``allow``; an empty list lets everything through; repeated
rows are judged each by themselves; texts are used whole; an empty table gives
an empty table; only the id and url columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: the filter has 512 bits for each eight keys (64 bits a key), and at most so
#: many blocks (4.5 MB): beyond it lets more false positives through to the
#: exact join, which keeps results the same
MAX_BLOCKS = 1 << 16
KEYS_A_BLOCK = 8
WORDS = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Scheme, query and fragment dropped, a leading ``www.`` or ``m.`` too; one
    spelling of the same page (``/x``, ``/x/`` and ``/x.html``)."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""),
                    F.regexp_replace(path, r"(\.html?|/)$", ""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(17)), F.lit(blocks).cast("long")).cast("int")


def _bit(key: Column, word: int) -> Column:
    """The one bit that the key sets in that word of its block."""
    place = F.shiftright(F.xxhash64(key), word * 8).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w7): the filter's non-empty blocks, from keys (key)."""
    bits = keys.select(_block(F.col("key"), blocks).alias("block"),
                       *[_bit(F.col("key"), w).alias(f"w{w}") for w in range(WORDS)])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(WORDS)])


def possible(df: DataFrame, key: str, filt: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``df`` whose key may be in the filter."""
    cols = df.columns
    hit = df.withColumn("block", _block(F.col(key), blocks)).join(F.broadcast(filt), "block")
    for w in range(WORDS):
        hit = hit.where(F.col(f"w{w}").bitwiseAND(_bit(F.col(key), w)) != 0)
    return hit.select(*cols)


def _rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(rule, rule_verdict, n): the rules as a table of literals."""
    empty = "cast(array() as array<struct<rule:string,verdict:string>>)"
    items = [F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")) for v, h, p in rules]
    table = spark.range(1).select(F.inline(F.array(*items) if items else F.expr(empty)))
    return table.groupBy("rule").agg(F.max("verdict").alias("rule_verdict"))


def judge(df: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``df``.

    ``rules``: a bounded list of (verdict, host, path).  ``listed``: a table
    whose column ``canonical`` holds blocked canonical urls, of any number.
    """
    spark = df.sparkSession
    listed = listed.select(F.col("canonical").alias("listed_url")).where("listed_url is not null").distinct()
    table = _rule_table(spark, rules)
    blocks, n = 1, listed.count() + len(rules)
    while blocks < MAX_BLOCKS and blocks * KEYS_A_BLOCK < n:
        blocks *= 2
    filt = bloom(listed.select(F.concat(F.lit("u "), "listed_url").alias("key"))
                 .union(table.select(F.concat(F.lit("r "), "rule"))), blocks)

    urls = df.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                     path_of(F.col(url_col)).alias("path"))
    # a verdict depends on host and path alone: look each pair up once
    labels = F.split("host", r"\.")
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels) - i), "."))
    lengths = sorted({len(p) for _, _, p in rules})
    fits = [F.when(F.char_length("path") >= n, F.substring("path", 1, n)) for n in lengths]
    prefixes = F.array_compact(F.array(*fits)) if fits else F.expr("cast(array() as array<string>)")
    rule_keys = F.flatten(F.transform(suffixes, lambda s: F.transform(
        prefixes, lambda p: F.concat(F.lit("r "), s, p))))
    keys = F.concat(F.array(F.concat(F.lit("u "), canonical(F.col("host"), F.col("path")))), rule_keys)
    asked = (urls.select("host", "path").distinct().where("host <> ''")
             .select("host", "path", F.explode(keys).alias("key")))
    hits = possible(asked, "key", filt, blocks)
    exact = (hits.where("key like 'u %'").select("host", "path", F.substring("key", 3, 2147483647).alias("listed_url"))
             .join(listed, "listed_url").select("host", "path", F.lit(None).cast("string").alias("rule"),
                                                F.lit(None).cast("string").alias("rule_verdict"))
             .union(hits.where("key like 'r %'")
                    .select("host", "path", F.substring("key", 3, 2147483647).alias("rule"))
                    .join(F.broadcast(table), "rule").select("host", "path", "rule", "rule_verdict")))
    # the smallest struct is the longest rule, then the first in text order
    best = exact.groupBy("host", "path").agg(
        F.max(F.col("rule").isNull()).alias("is_listed"),
        F.min(F.when(F.col("rule").isNotNull(), F.struct((-F.char_length("rule")).alias("n"), F.col("rule"),
                                                         F.col("rule_verdict")))).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.rule_verdict"), F.when(F.col("is_listed"), "block").otherwise("allow")).alias("verdict"))


def listed_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Canonical urls of the pages whose document is labelled toxic: the block
    list that the registered query looks up."""
    toxic = labels.where("toxic = 1").select(F.col("doc_id").alias("page_id")).distinct()
    found = pages.select("page_id", "url").join(toxic, "page_id", "left_semi")
    return found.select(canonical(host_of(F.col("url")), path_of(F.col("url"))).alias("canonical"),
                        host_of(F.col("url")).alias("host")).where("host <> ''").select("canonical").distinct()


#: the rules of the registered query: (verdict, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
