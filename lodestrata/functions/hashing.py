"""Hash expressions, all native; digests are lower-case hex."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_text(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def address_id(address: Column, chain: str = "bitcoin") -> Column:
    return sha256_text(F.concat(F.lit(f"{chain}:"), address))


def script_id(script_hex: Column, chain: str = "bitcoin:mainnet") -> Column:
    """Over bytes: the chain, a zero byte, the script; a missing script is empty."""
    return F.sha2(F.concat(F.encode(F.lit(chain), "UTF-8"), F.unhex(F.lit("00")), F.unhex(F.coalesce(script_hex, F.lit("")))), 256)


def bucket(address: Column, buckets: int = 64) -> Column:
    """The digest's first four bytes, big-endian, modulo buckets."""
    return F.conv(F.substring(sha256_text(address), 1, 8), 16, 10).cast("bigint") % buckets


def control_sample(campaign: str, identifier: Column, numerator: int = 2, denominator: int = 100) -> Column:
    """Whether the first eight bytes of sha256(campaign:id) fall under the share; hex of equal width compares as numbers do."""
    threshold = f"{(1 << 64) * numerator // denominator:016x}"
    return F.substring(sha256_text(F.concat(F.lit(f"{campaign}:"), identifier)), 1, 16) < threshold


def unit_separated(*columns: Column) -> Column:
    return F.concat(*[x for c in columns for x in (F.lit("\x1f"), c.cast("string"))][1:])


def fingerprint(**columns: Column) -> Column:
    """SHA-256 of compact JSON with sorted keys; nulls are written."""
    ordered = F.struct(*[columns[k].alias(k) for k in sorted(columns)])
    return sha256_text(F.to_json(ordered, {"ignoreNullFields": "false"}))


def utc_micros(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole periods of 24 hours, not calendar days."""
    return F.timestamp_diff("DAY", start, end)
