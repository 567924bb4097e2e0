"""Column encryption with Spark's own AES expressions.

``encrypt``/``decrypt`` are for new data: GCM with a random nonce per value.
``encrypt_fixed_iv``/``decrypt_fixed_iv`` read and write the stored credential
format: hex of AES-CBC under a constant vector, the text padded with NUL bytes.
That format is deterministic and unauthenticated; use it for existing values only.

The key is part of the plan; set ``spark.sql.redaction.string.regex`` where plans
are logged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Fixed values of the stored credential format.
FIXED_IV = b"0000000000000000"
BLOCK = 16
KEY_LENGTHS = (16, 24, 32)


def _key(key: str) -> Column:
    raw = key.encode("utf-8")
    if len(raw) not in KEY_LENGTHS:
        raise ValueError(f"key must have 16, 24 or 32 bytes, got {len(raw)}")
    return F.lit(raw)


def encrypt(col: Column, key: str) -> Column:
    """Hex text of the encrypted value; NULL stays NULL."""
    return F.hex(F.aes_encrypt(col.cast("string").cast("binary"), _key(key)))


def decrypt(col: Column, key: str) -> Column:
    """Inverse of :func:`encrypt`; a wrong key fails the query."""
    return F.aes_decrypt(F.unhex(col), _key(key)).cast("string")


def encrypt_fixed_iv(col: Column, key: str) -> Column:
    """Encrypt into the stored credential format (lower-case hex)."""
    raw = col.cast("string").cast("binary")
    pad = F.lit(BLOCK) - F.octet_length(raw) % BLOCK
    padded = F.concat(raw, F.substring(F.lit(bytes(BLOCK)), F.lit(1), pad))
    # Spark prepends the vector and, the text being whole blocks, appends one
    # block of its own padding. Both are cut off again.
    full = F.aes_encrypt(padded, _key(key), F.lit("CBC"), F.lit("PKCS"), F.lit(FIXED_IV))
    return F.lower(F.hex(F.substring(full, F.lit(BLOCK + 1), F.octet_length(padded))))


def decrypt_fixed_iv(col: Column, key: str) -> Column:
    """Decrypt the stored credential format; trailing NUL bytes are dropped."""
    k = _key(key)
    cipher = F.unhex(col)
    # Spark insists on its own padding at the end, so a block that decrypts to
    # exactly that padding is made from the last cipher block and appended.
    tail = F.substring(cipher, F.octet_length(cipher) - (BLOCK - 1), F.lit(BLOCK))
    mixed = F.concat(_flip(tail, 1), _flip(tail, 9))
    closing = F.substring(F.aes_encrypt(mixed, k, F.lit("ECB"), F.lit("PKCS")), 1, BLOCK)
    plain = F.aes_decrypt(F.concat(F.lit(FIXED_IV), cipher, closing), k, F.lit("CBC"), F.lit("PKCS"))
    return F.regexp_replace(plain.cast("string"), "\\x00+$", "")


def _flip(block: Column, start: int) -> Column:
    """Eight bytes of ``block`` xor 0x10, as binary (two 32-bit halves)."""
    mask = 0x10101010

    def half(at: int) -> Column:
        number = F.conv(F.hex(F.substring(block, at, 4)), 16, 10).cast("bigint")
        return F.unhex(F.lpad(F.hex(number.bitwiseXOR(F.lit(mask).cast("bigint"))), 8, "0"))

    return F.concat(half(start), half(start + 4))


def map_values(col: Column, change: Callable[[Column], Column]) -> Column:
    """Apply ``change`` to every value of a map column, keys untouched."""
    return F.transform_values(col, lambda _, value: change(value))
