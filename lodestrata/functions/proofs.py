"""Proofs of control: two recovered message signatures against a 2-of-3 script."""

from __future__ import annotations

import base64
import binascii
import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .addresses import base58check

# The curve secp256k1.
FIELD = 2**256 - 2**32 - 977
ORDER = 0xFFFFFFFFFFFFFFFFFFFFFFFFFFFFFFFEBAAEDCE6AF48A03BBFD25E8CD0364141
BASE = (0x79BE667EF9DCBBAC55A06295CE870B07029BFCDB2DCE28D959F2815B16F81798, 0x483ADA7726A3C4655DA4FBFC0E1108A8FD17B448A68554199C47D08FFB10D4B8)

Point = tuple[int, int] | None


def plus(a: Point, b: Point) -> Point:
    if a is None or b is None:
        return a or b
    (ax, ay), (bx, by) = a, b
    if ax == bx:
        if (ay + by) % FIELD == 0:
            return None
        m = 3 * ax * ax * pow(2 * ay, -1, FIELD)
    else:
        m = (by - ay) * pow(bx - ax, -1, FIELD)
    x = (m * m - ax - bx) % FIELD
    return x, (m * (ax - x) - ay) % FIELD


def times(k: int, p: Point) -> Point:
    out: Point = None
    for bit in bin(k)[2:]:
        out = plus(out, out)
        if bit == "1":
            out = plus(out, p)
    return out


def encoded(p: tuple[int, int], compressed: bool) -> bytes:
    x = p[0].to_bytes(32, "big")
    return bytes([2 + p[1] % 2]) + x if compressed else b"\x04" + x + p[1].to_bytes(32, "big")


def message_digest(message: str) -> bytes:
    def sized(b: bytes) -> bytes:
        n = len(b)
        head = bytes([n]) if n < 253 else b"\xfd" + n.to_bytes(2, "little") if n < 65536 else b"\xfe" + n.to_bytes(4, "little")
        return head + b

    return hashlib.sha256(hashlib.sha256(sized(b"Bitcoin Signed Message:\n") + sized(message.encode())).digest()).digest()


def recovered_key(signature: str, digest: bytes) -> bytes | None:
    """The public key that made a compact signature; null if there is none."""
    try:
        raw = base64.b64decode(signature, validate=True)
    except (binascii.Error, ValueError):
        return None
    if len(raw) != 65 or not 27 <= raw[0] <= 34:
        return None
    flags, r, s = raw[0] - 27, int.from_bytes(raw[1:33], "big"), int.from_bytes(raw[33:], "big")
    x = r + ORDER * (flags >> 1 & 1)
    if not (0 < r < ORDER and 0 < s < ORDER and x < FIELD):
        return None
    y = pow(x**3 + 7, (FIELD + 1) // 4, FIELD)
    if (y * y - x**3 - 7) % FIELD:
        return None
    if y % 2 != flags & 1:
        y = FIELD - y
    inverse, z = pow(r, -1, ORDER), int.from_bytes(digest, "big")
    key = plus(times(s * inverse % ORDER, (x, y)), times(-z * inverse % ORDER, BASE))
    return None if key is None else encoded(key, flags >= 4)


def script_keys(script: bytes) -> set[bytes] | None:
    """The three keys of a script that asks for two of them."""
    if len(script) < 4 or script[0] != 0x52 or script[-2:] != b"\x53\xae":
        return None
    keys, at = set(), 1
    while at < len(script) - 2:
        n = script[at]
        if n not in (33, 65):
            return None
        keys.add(script[at + 1 : at + 1 + n])
        at += 1 + n
    return keys if len(keys) == 3 and at == len(script) - 2 else None


def script_address(script: bytes) -> str:
    return base58check(b"\x05" + hashlib.new("ripemd160", hashlib.sha256(script).digest()).digest())


def two_of_three(address: str, message: str, first: str, second: str, script_hex: str) -> bool:
    """Whether two different keys of the address's own script signed the message."""
    try:
        script = bytes.fromhex(script_hex)
        keys = script_keys(script)
        if keys is None or script_address(script) != address:
            return False
        digest = message_digest(message)
        signers = {recovered_key(first, digest), recovered_key(second, digest)}
        return None not in signers and len(signers) == 2 and signers <= keys
    except (ValueError, TypeError, AttributeError):
        return False


def verify_2of3_proof(address: Column, message: Column, first: Column, second: Column, script_hex: Column) -> Column:
    @F.pandas_udf("boolean")
    def verified(a: pd.Series, m: pd.Series, x: pd.Series, y: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([two_of_three(*row) for row in zip(a, m, x, y, h, strict=True)])

    return verified(address, message, first, second, script_hex)
