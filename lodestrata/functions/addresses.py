"""Validation of Bitcoin mainnet addresses, as an Arrow-batched UDF: the one scalar that SQL can't express."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The two alphabets, the checksum constants and its generator.
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
CHECKSUM = {1: "bech32", 0x2BC830A3: "bech32m"}
GENERATOR = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
VERSIONS = {0: "p2pkh", 5: "p2sh"}


def base58check(body: bytes) -> str:
    """Text of a version byte and hash, with its checksum."""
    raw = body + hashlib.sha256(hashlib.sha256(body).digest()).digest()[:4]
    n, out = int.from_bytes(raw, "big"), ""
    while n:
        n, r = divmod(n, 58)
        out = BASE58[r] + out
    return "1" * (len(raw) - len(raw.lstrip(b"\0"))) + out


def _legacy(text: str) -> tuple[str, str]:
    n = 0
    for ch in text:
        if (d := BASE58.find(ch)) < 0:
            raise ValueError("base58 character")
        n = n * 58 + d
    raw = b"\0" * (len(text) - len(text.lstrip("1"))) + n.to_bytes(-(-n.bit_length() // 8), "big")
    if len(raw) != 25:
        raise ValueError("base58 length")
    if base58check(raw[:-4]) != text:
        raise ValueError("base58 checksum")
    if raw[0] not in VERSIONS:
        raise ValueError("network")
    return text, VERSIONS[raw[0]]


def _checksum(values: list[int]) -> int:
    acc = 1
    for v in values:
        high, acc = acc >> 25, (acc & 0x1FFFFFF) << 5 ^ v
        for bit, g in enumerate(GENERATOR):
            if high >> bit & 1:
                acc ^= g
    return acc


def _segwit(text: str) -> tuple[str, str]:
    if text not in (text.lower(), text.upper()):
        raise ValueError("mixed case")
    low = text.lower()
    prefix, _, data = low.rpartition("1")
    if prefix != "bc":
        raise ValueError("network")
    five = [BECH32.find(ch) for ch in data]
    if len(five) < 7 or min(five) < 0:
        raise ValueError("bech32 data")
    kind = CHECKSUM.get(_checksum([ord(ch) >> 5 for ch in prefix] + [0] + [ord(ch) & 31 for ch in prefix] + five))
    if kind is None:
        raise ValueError("bech32 checksum")
    version, payload = five[0], five[1:-6]
    bits = "".join(f"{x:05b}" for x in payload)
    size, rest = divmod(len(bits), 8)
    if version > 16 or not 2 <= size <= 40 or rest > 4 or "1" in bits[size * 8 :]:
        raise ValueError("witness program")
    if version == 0:
        if kind != "bech32" or size not in (20, 32):
            raise ValueError("version 0 program")
        return low, "p2wpkh" if size == 20 else "p2wsh"
    if kind != "bech32m":
        raise ValueError("needs bech32m")
    return low, "p2tr" if version == 1 and size == 32 else "segwit_v1_plus"


def normalized(text: str | None) -> tuple[str, str]:
    """The canonical form and type of a mainnet address; ValueError if it is none."""
    if not text:
        raise ValueError("empty")
    low = text.lower()
    if low.startswith(("tb1", "bcrt1")):
        raise ValueError("network")
    return _segwit(text) if low.startswith("bc1") else _legacy(text)


def _judged(text: str | None) -> tuple:
    try:
        form, kind = normalized(text)
        return form, hashlib.sha256(f"bitcoin:{form}".encode()).hexdigest(), kind, None
    except ValueError as e:
        return None, None, None, str(e)


def normalize_address(column: Column) -> Column:
    """struct<normalized_address, address_id, address_type, error> of each text."""

    @F.pandas_udf("normalized_address string, address_id string, address_type string, error string")
    def judged(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_judged(t) for t in texts], columns=["normalized_address", "address_id", "address_type", "error"])

    return judged(column)
