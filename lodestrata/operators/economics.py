"""Per-address economics in two levels, each summed in part before its shuffle.

First (address, block, transaction), then the address: both shuffles are dealt
evenly, and an address with a third of all rows sends one partial row a task to
its second group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import address_id, script_id
from .flatten import since, single_address

BTC = 100_000_000
RECEIPT = 500 * BTC


def _cut(df: DataFrame, time: str) -> Column:
    return F.lit(time).cast(df.schema["block_timestamp"].dataType)


def _if(cond: Column, value: Column, other: object = 0) -> Column:
    return F.when(cond, value).otherwise(F.lit(other).cast("decimal(38,0)") if other == 0 else other)


def _long(c: Column) -> Column:
    return c.cast("bigint")


def per_transaction(io: DataFrame) -> DataFrame:
    """Received, spent and gross of each address in each transaction; the key is (block, transaction), never the hash alone."""
    rows = single_address(io).where(F.col("value_sats").isNotNull())
    v, kind = F.col("value_sats"), F.col("row_kind")
    return rows.groupBy("normalized_address", "block_hash", "transaction_hash").agg(
        F.max("block_timestamp").alias("block_timestamp"), F.sum(_if(kind == "output", v)).alias("tx_received_sats"),
        F.sum(_if(kind == "input", v)).alias("tx_spent_sats"), F.sum(v).alias("tx_gross_sats"),
    )


def address_economics(io: DataFrame, cutoff_time: str) -> DataFrame:
    """Lifetime and windowed economics of every address; one row an address."""
    tx = per_transaction(io)
    cut, ts = _cut(tx, cutoff_time), F.col("block_timestamp")
    received, gross = F.col("tx_received_sats"), F.col("tx_gross_sats")
    d90, d365, large = since(ts, cut, 90), since(ts, cut, 365), received >= RECEIPT
    return tx.groupBy("normalized_address").agg(
        _long(F.sum(received)).alias("lifetime_received_sats"), _long(F.sum("tx_spent_sats")).alias("lifetime_spent_sats"),
        _long(F.sum(received) - F.sum("tx_spent_sats")).alias("current_utxo_sats"), _long(F.sum(_if(d90, gross))).alias("gross_flow_90d_sats"),
        F.max(ts).alias("last_seen_time"), _long(F.max(received)).alias("max_same_tx_received_lifetime_sats"),
        _long(F.max(_if(d90, received))).alias("max_same_tx_received_90d_sats"),
        _long(F.max(_if(d365, received))).alias("max_same_tx_received_365d_sats"),
        F.count_if(large).alias("same_tx_receive_ge_500_btc_lifetime_count"), F.count_if(d90 & large).alias("same_tx_receive_ge_500_btc_90d_count"),
        F.count_if(d365 & large).alias("same_tx_receive_ge_500_btc_365d_count"), F.count_if(d90).alias("active_tx_90d_count"),
        F.count_if(d365).alias("active_tx_365d_count"),
        # distinct days without a distinct aggregate: the set holds at most 366 dates
        F.size(F.collect_set(F.when(d90, F.to_date(ts)))).cast("bigint").alias("active_day_90d_count"),
        F.size(F.collect_set(F.when(d365, F.to_date(ts)))).cast("bigint").alias("active_day_365d_count"),
        F.max(F.when(large, ts)).alias("last_same_tx_receive_ge_500_btc_time"),
        (F.count_if(received > 0) > 0).alias("has_output"), (F.count_if(F.col("tx_spent_sats") > 0) > 0).alias("has_input"),
    )


def economics_v1(io: DataFrame, cutoff_time: str) -> DataFrame:
    """The first policy's economics: an address is a receiver by any output row, also of value zero."""
    rows = single_address(io).where(F.col("value_sats").isNotNull())
    tx = rows.groupBy("normalized_address", "block_hash", "transaction_hash", "row_kind").agg(
        F.max("block_timestamp").alias("block_timestamp"), F.sum("value_sats").alias("v")
    )
    ts, v, out = F.col("block_timestamp"), F.col("v"), F.col("row_kind") == "output"
    return tx.groupBy("normalized_address").agg(
        _long(F.sum(_if(out, v))).alias("lifetime_received_sats"), _long(F.sum(_if(~out, v))).alias("lifetime_spent_sats"),
        _long(F.sum(F.when(out, v).otherwise(-v))).alias("current_utxo_sats"), _long(F.max(_if(out, v))).alias("max_same_tx_received_sats"),
        _long(F.sum(_if(since(ts, _cut(tx, cutoff_time), 90), v))).alias("gross_flow_90d_sats"), F.max(ts).alias("last_seen_time"),
        (F.count_if(out) > 0).alias("has_output"), (F.count_if(~out) > 0).alias("has_input"),
    )


def received_by_transaction(io: DataFrame) -> DataFrame:
    rows = single_address(io).where("row_kind = 'output' and value_sats is not null")
    return rows.groupBy("block_hash", "transaction_hash", "normalized_address").agg(F.sum("value_sats").alias("same_tx_received_sats"))


def large_counterparties(io: DataFrame, least_sats: int = 100 * BTC) -> DataFrame:
    """For each address, how many others received at least so much in a transaction with it.

    Transactions of one large receiver are dropped by their count. An address
    of one such transaction has all its other receivers, which the count
    gives; only addresses of several need the others by name, so only these make
    pairs, and each transaction's receivers are dealt to them by the join.
    """
    key = ["block_hash", "transaction_hash"]
    large = received_by_transaction(io).where(F.col("same_tx_received_sats") >= least_sats).select(*key, "normalized_address")
    sizes = large.groupBy(*key).agg(F.count("*").alias("_receivers")).where("_receivers > 1")
    shared = large.join(sizes, key)
    by = shared.groupBy("normalized_address").agg(F.count("*").alias("_transactions"), F.max("_receivers").alias("_receivers"))
    name = "direct_large_counterparty_count"
    once = by.where("_transactions = 1").select("normalized_address", (F.col("_receivers") - 1).alias(name))
    often = shared.select(*key, "normalized_address").join(by.where("_transactions > 1").select("normalized_address"), "normalized_address")
    others = shared.select(*key, F.col("normalized_address").alias("_other"))
    pairs = often.join(others, key).where(F.col("normalized_address") != F.col("_other")).select("normalized_address", "_other").distinct()
    return once.union(pairs.groupBy("normalized_address").agg(F.count("*").alias(name)))


def _windowed(kind: str, cut: Column) -> list[Column]:
    ts, v = F.col("block_timestamp"), F.col("value_sats")
    return [_long(F.sum(_if((F.col("row_kind") == kind) & since(ts, cut, d), v))).alias(f"_{kind}_{d}") for d in (30, 90, 365)]


def address_features(io: DataFrame, cutoff_time: str, large_sats: int = 100 * BTC) -> DataFrame:
    """The 24 features of every address with an output; input-only addresses are dropped.

    One grouping by transaction and one by address replace the joins of separate
    output, input, transaction and maximum tables; each sums in part before its shuffle.
    """
    rows = single_address(io).where("value_sats is not null")
    cut, out, v, ts, h = _cut(rows, cutoff_time), F.col("row_kind") == "output", F.col("value_sats"), F.col("block_timestamp"), F.col("block_number")
    sums = [c for kind in ("output", "input") for c in _windowed(kind, cut)]
    tx = rows.groupBy("normalized_address", "block_hash", "transaction_hash").agg(
        F.min(h).alias("h0"), F.max(h).alias("h1"), F.min(ts).alias("t0"), F.max(ts).alias("t1"), F.count_if(out).alias("n_out"),
        F.count_if(~out).alias("n_in"),
        F.sum(_if(out, v)).alias("received"), F.sum(_if(~out, v)).alias("spent"), F.max(_if(out, v)).alias("largest"),
        F.min(F.when(out, F.col("script_type"))).alias("kind"), *sums,
    )
    total = lambda c: _long(F.sum(c))
    by = tx.groupBy("normalized_address").agg(
        F.min("kind").alias("address_type"), F.min("h0").alias("first_seen_height"), F.max("h1").alias("last_seen_height"),
        F.min("t0").alias("first_seen_time"),
        F.max("t1").alias("last_seen_time"), total("n_out").alias("output_count"), total("n_in").alias("spent_output_count"),
        F.count("*").alias("transaction_count"),
        _long(F.sum("received") - F.sum("spent")).alias("current_utxo_sats"), total("received").alias("lifetime_received_sats"),
        total("spent").alias("lifetime_spent_sats"),
        _long(F.max("largest")).alias("max_single_output_sats"), _long(F.max("received")).alias("max_same_tx_received_sats"),
        *[total(f"_{kind}_{d}").alias(f"{name}_{d}d_sats") for kind, name in (("output", "inflow"), ("input", "outflow")) for d in (30, 90, 365)],
    ).where("output_count > 0")
    for d in (30, 90, 365):
        by = by.withColumn(f"gross_flow_{d}d_sats", F.col(f"inflow_{d}d_sats") + F.col(f"outflow_{d}d_sats"))
    by = by.drop("inflow_365d_sats", "outflow_365d_sats").join(large_counterparties(io, large_sats), "normalized_address", "left")
    count = F.coalesce("direct_large_counterparty_count", F.lit(0).cast("bigint"))
    return by.withColumn("direct_large_counterparty_count", count).withColumn("address_id", address_id(F.col("normalized_address"))).withColumn("feature_version", F.lit("features_v1"))


def address_scale(io: DataFrame) -> DataFrame:
    """How many distinct addresses lead an output's list; exact."""
    return io.where("row_kind = 'output'").select(F.get("addresses", F.lit(0)).alias("a")).agg(F.count_distinct("a").alias("address_count"))


def script_subjects(io: DataFrame) -> DataFrame:
    """One row a script. Missing and empty scripts share an id, so they are one group."""
    hex_ = F.coalesce("script_hex", F.lit(""))
    row = F.struct(F.size("addresses").alias("n"), F.get("addresses", F.lit(0)).alias("a"), F.col("script_type").alias("t"))
    first = io.where("row_kind = 'output'").groupBy(hex_.alias("script_hex")).agg(F.min(row).alias("r"))
    one = F.col("r.n") == 1
    return first.select(
        script_id(F.col("script_hex")).alias("script_id"), "script_hex", F.col("r.t").alias("script_type"),
        F.when(one, F.col("r.a")).alias("normalized_address"),
        F.when(one, address_id(F.col("r.a"))).alias("address_id"), one.alias("provider_enrichable"),
    )


def source_accounting(io: DataFrame) -> DataFrame:
    """Nine counts in one pass."""
    out, n = F.col("row_kind") == "output", F.size("addresses")
    return io.agg(
        F.count_if(out).alias("total_output_rows"), F.count_if(~out).alias("total_input_rows"),
        F.count_distinct(F.when(out, F.coalesce("script_hex", F.lit("")))).alias("distinct_script_subjects"),
        F.count_if(out & (n == 1)).alias("standard_single_address_rows"), F.count_if(out & (n == 0)).alias("empty_address_rows"),
        F.count_if(out & (n > 1)).alias("multi_address_rows"),
        F.count_if(out & (F.lower(F.coalesce("script_type", F.lit(""))) == "nonstandard")).alias("nonstandard_rows"),
        F.count_if(out & (F.coalesce("script_hex", F.lit("")) == "")).alias("missing_script_hex_rows"),
        F.count_if(~out & F.col("value_sats").isNull()).alias("unmatched_input_rows"),
    )


def source_checkpoint(tx: DataFrame, blocks: DataFrame, as_of: str, finality_depth: int = 6) -> DataFrame:
    """The latest and the finalized block of the last seven days, and their taproot outputs."""
    from pyspark.sql.window import Window

    from .flatten import recent

    days = recent(blocks, as_of, ts="timestamp", month="timestamp_month").groupBy("number", "hash").agg(F.max("timestamp").alias("time"))
    # a week has about a thousand blocks; the window holds the top few only
    ranked = days.withColumn("r", F.row_number().over(Window.orderBy(F.desc("number")))).where(F.col("r") <= finality_depth + 1)

    def pick(k: int, c: str) -> Column:
        return F.max(F.when(F.col("r") == k, F.col(c)))

    one = ranked.agg(
        pick(1, "number").alias("latest_height"), pick(1, "hash").alias("latest_hash"), pick(1, "time").alias("latest_time"),
        pick(finality_depth + 1, "number").alias("finalized_height"), pick(finality_depth + 1, "hash").alias("finalized_hash"),
    )
    outs = recent(tx, as_of).select(F.explode("outputs.addresses").alias("a"))
    taproot = outs.agg(F.count_if((F.size("a") == 1) & F.startswith(F.lower(F.get("a", F.lit(0))), F.lit("bc1p"))).alias("taproot_address_count"))
    return one.crossJoin(taproot)  # one row each
