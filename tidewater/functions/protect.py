"""Column protection: AES encrypt/decrypt and keyed tokens.

All built on Spark's own ``aes_encrypt``/``aes_decrypt``/``sha2`` -- JVM
expressions in the same Project as the rest of the row, no Python.

Modes:
* ``ECB``  deterministic: equal plaintext gives equal ciphertext, so joins
  and GROUP BY on ciphertext work (C5).  Leaks equality; kept for parity.
* ``GCM``  random IV per value: the storage mode.
* ``token`` (HMAC with SHA-256) is the join key to use with GCM.

The key is always an explicit argument (D2); it must be 16, 24 or 32 bytes.
"""

from __future__ import annotations

import hashlib

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID_KEY_BYTES = (16, 24, 32)


def _check_key(key: str | bytes) -> None:
    n = len(key.encode("utf-8") if isinstance(key, str) else key)
    if n not in VALID_KEY_BYTES:
        raise ValueError(f"AES key must be 16, 24 or 32 bytes, got {n}")


def encrypt(col: str | Column, key: str, mode: str = "ECB") -> Column:
    """Cast to string -> AES -> base64 text.  NULL stays NULL."""
    _check_key(key)
    c = F.col(col) if isinstance(col, str) else col
    return F.base64(F.aes_encrypt(c.cast("string"), F.lit(key), F.lit(mode)))


def decrypt(col: str | Column, key: str, mode: str = "ECB", strict: bool = False,
            to_type: str = "string") -> Column:
    """base64 -> AES -> string (cast to ``to_type``).

    ``strict=False`` returns NULL for a wrong key or damaged ciphertext
    instead of failing the job."""
    _check_key(key)
    c = F.col(col) if isinstance(col, str) else col
    fn = F.aes_decrypt if strict else F.try_aes_decrypt
    return fn(F.unbase64(c), F.lit(key), F.lit(mode)).cast("string").cast(to_type)


def token(col: str | Column, key: str) -> Column:
    """Keyed, deterministic join token: HMAC with SHA-256, in hex.  The inner
    and outer key pads are those of the standard, so a token can be neither
    extended nor made without the key."""
    c = F.col(col) if isinstance(col, str) else col
    raw = key.encode("utf-8")
    raw = (hashlib.sha256(raw).digest() if len(raw) > 64 else raw).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in raw)) for pad in (0x36, 0x5C))
    within = F.unhex(F.sha2(F.concat(inner, c.cast("string").cast("binary")), 256))
    return F.sha2(F.concat(outer, within), 256)


def _apply(df: DataFrame, names: Iterable[str], fn) -> DataFrame:
    wanted = set(names)
    # one Project; column order kept; names absent from df are ignored,
    # matching is exact (case-sensitive) like the reference's list test
    return df.select(*[fn(c).alias(c) if c in wanted else F.col(f"`{c}`")
                       for c in df.columns])


def protect_columns(df: DataFrame, sensitive: Sequence[str], key: str,
                    mode: str = "ECB") -> DataFrame:
    """Encrypt the listed columns, keep the others as they are."""
    return _apply(df, sensitive, lambda c: encrypt(F.col(f"`{c}`"), key, mode))


def unprotect_columns(df: DataFrame, sensitive: Sequence[str], key: str,
                      mode: str = "ECB", strict: bool = False,
                      types: dict[str, str] | None = None) -> DataFrame:
    """C4: decrypt the listed columns (optionally restoring their types)."""
    types = types or {}
    return _apply(df, sensitive, lambda c: decrypt(F.col(f"`{c}`"), key, mode, strict,
                                                   types.get(c, "string")))
