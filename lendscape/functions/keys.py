"""Row fingerprints, business keys and masking."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import HASH_SEPARATOR, NULL_MARK


def record_hash(columns: Sequence[str], null_safe: bool = False) -> Column:
    """SHA-256 over the joined values.

    By default NULLs are skipped, so rows with NULLs in different places can
    share a hash; ``null_safe`` writes a mark for each NULL instead.
    """
    parts = [F.col(c).cast("string") for c in columns]
    if null_safe:
        parts = [F.coalesce(p, F.lit(NULL_MARK)) for p in parts]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)


def record_key(customer: str = "customer_id", loan: str = "loan_id") -> Column:
    """``customer||loan``; NULL when either part is."""
    return F.concat(F.col(customer), F.lit(HASH_SEPARATOR), F.col(loan))


def masked_id(column: str, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), F.col(column)), 256)


def hmac_sha256(text: Column, inner: Column, outer: Column) -> Column:
    """Keyed hash of a text as hex digits, from the two padded keys (:func:`hmac_pads`); NULL stays NULL."""
    first = F.unhex(F.sha2(F.concat(inner, F.encode(text, "utf-8")), 256))
    return F.sha2(F.concat(outer, first), 256)


def hmac_pads(key: bytes) -> tuple[bytes, bytes]:
    """The key padded to a block of SHA-256, for the inner and the outer hash."""
    if len(key) > 64:
        key = sha256(key).digest()
    block = key.ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)


def padded_key(prefix: str, number: Column) -> Column:
    """``CUST00000001``; numbers longer than eight digits keep all of them."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= 8, digits).otherwise(F.lpad(digits, 8, "0")))


def unit_hash(columns: Sequence[str], seed: int) -> Column:
    """Repeatable pseudo-random number in [0, 1) from row values.

    28 bits of an MD5, so that a row keeps its number on any cluster layout.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("bigint") / F.lit(float(16**7))
