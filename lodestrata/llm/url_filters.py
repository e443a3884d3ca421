"""URL filters as a sort-merge range join, with DataFrame functions alone.

A host's labels are reversed and joined with full stops, one more at the end,
so a rule's host becomes a prefix of its subdomains' keys, and that prefix an
interval of the key order: from "com.example." to before "com.example/".
Intervals nest. A sweep over their sorted ends folds a stack of the rules that
are active from each end on. Urls and ends are sorted together in each slice,
and each url takes the stack of the last end at or before its key; of that
stack, the longest rule whose path starts the url's path decides.

Urls are dealt to slices by a hash of the whole url, so a host with most of
all rows has no slice of its own. Ends are repeated in each slice: at most
MAX_RULES rules are taken, which is checked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, free_name, partitions

RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
MAX_RULES = 100_000
#: ends in a block of the sweep
SWEEP = 512


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ://, up to / ? # or the end, A-Z in lower case; then up to ? # or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def reversed_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.", -1)), "."), F.lit("."))


def _ends(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row for each end of an interval: its key and the stack of rules active from there on."""
    rows = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    rows = rows.select(reversed_key(ascii_lower(F.col("host"))).alias("lo"), "host", "path", "verdict")
    rows = rows.withColumn("hi", F.concat(F.expr("left(lo, length(lo) - 1)"), F.lit("/")))
    rule = F.struct(
        (F.char_length("host") + F.char_length("path")).alias("size"), F.char_length("host").alias("host_size"),
        ascii_lower(F.col("host")).alias("host"), "path", "verdict", "hi",
    )
    per_key = rows.groupBy("lo", "hi").agg(F.sort_array(F.collect_list(rule)).alias("rules"))
    events = per_key.select(F.explode(F.array(
        F.struct(F.col("lo").alias("key"), F.lit(1).alias("opens"), "rules"),
        F.struct(F.col("hi").alias("key"), F.lit(0).alias("opens"), F.expr("filter(rules, x -> false)").alias("rules")),
    )).alias("e"))
    ordered = events.agg(F.sort_array(F.collect_list("e")).alias("events"))
    # the sweep: what ended at this key leaves the stack, then what opens here joins it. First over blocks of ends, for
    # the stack that each block starts with, then within each, so no list of all stacks is copied at every end
    after = "concat(filter({}, r -> r.hi > e.key), e.rules)"
    block, count = f"slice(events, k * {SWEEP} + 1, {SWEEP})", f"cast(ceil(size(events) / {SWEEP}D) as int)"
    nothing = "filter(events[0].rules, r -> false)"
    begin = f"aggregate(sequence(0, {count} - 1), array({nothing}), (acc, k) -> concat(acc, array(aggregate({block}, element_at(acc, -1), (st, e) -> {after.format('st')}))))"
    step = f"named_struct('key', e.key, 'stack', {after.format('element_at(acc, -1).stack')})"
    within = f"aggregate({block}, array(named_struct('key', '', 'stack', get(begin, k))), (acc, e) -> concat(acc, array({step})), acc -> slice(acc, 2, size(acc)))"
    swept = ordered.withColumn("begin", F.expr(begin)).select(
        F.expr(f"concat(array(named_struct('key', '', 'stack', {nothing})), flatten(transform(sequence(0, {count} - 1), k -> {within})))").alias("ends")
    )
    ends = swept.select(F.posexplode("ends").alias("n", "e")).select("n", "e.key", "e.stack")
    return ends.groupBy("key").agg(F.max_by("stack", "n").alias("stack"))


def _fields(pages: DataFrame) -> list[Column]:
    return [F.col("_row").getField(c).alias(c) for c in pages.columns]


def _named(pages: DataFrame, *values: Column) -> list[Column]:
    return [v.alias(free_name(n, pages.columns)) for n, v in zip(("_host", "_path", "_rule", "_verdict"), values, strict=True)]


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow", url_col: str = "url", slices: int | None = None) -> DataFrame:
    """pages' columns with host, path, rule and verdict added (_host, _path, _rule, _verdict; one more underscore where pages has such a column).

    A rule (host, path, verdict) fits its host and subdomains where the url's
    path starts with its own; the longest host and path together wins, then the
    longest host. No rule: null, and the default verdict. A null url, or one
    without ://, has an empty host and path. Rows that repeat stay repeated.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are repeated in each slice")
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.struct("*").alias("_row"), host.alias("_host"), path.alias("_path"))
    if not rules:
        none = F.lit(None).cast("string")
        return urls.select(*_fields(pages), *_named(pages, F.col("_host"), F.col("_path"), none, F.lit(default)))
    n = slices or partitions(spark)
    urls = urls.select("_row", "_host", "_path", reversed_key(F.col("_host")).alias("_key"), F.lit(None).alias("_stack"), F.lit(1).alias("_kind"))
    urls = urls.withColumn("_slice", F.pmod(F.xxhash64(F.col(f"_row.{url_col}"), F.struct("_row")), F.lit(n)).cast("int"))
    ends = _ends(spark, rules).select(
        F.lit(None).alias("_row"), F.lit("").alias("_host"), F.lit("").alias("_path"), F.col("key").alias("_key"),
        F.col("stack").alias("_stack"), F.lit(0).alias("_kind"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_slice"),
    )
    w = Window.partitionBy("_slice").orderBy("_key", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    seen = urls.unionByName(ends).select("*", F.last("_stack", True).over(w).alias("_active")).where("_kind = 1")
    fits = F.filter("_active", lambda r: F.startswith(F.col("_path"), r["path"]))
    best = F.array_max(fits)
    rule, verdict = F.concat("_best.host", "_best.path"), F.coalesce("_best.verdict", F.lit(default))
    return seen.select("_row", "_host", "_path", best.alias("_best")).select(*_fields(pages), *_named(pages, F.col("_host"), F.col("_path"), rule, verdict))
