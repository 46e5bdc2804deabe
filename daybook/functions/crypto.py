"""Encrypted text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decrypted(column: str | Column, key: bytes, iv: bytes) -> Column:
    """Base64 text decrypted with AES-CBC and PKCS padding; the value itself where that fails.

    Spark expects the initialisation vector in front of the ciphertext. Failure is any of: no
    base64, wrong key or padding, or bytes that are not UTF-8.
    """
    c = F.col(column) if isinstance(column, str) else column
    message = F.concat(F.lit(iv), F.try_to_binary(c, F.lit("base64")))
    plain = F.try_aes_decrypt(message, F.lit(key), F.lit("CBC"), F.lit("PKCS"))
    return F.coalesce(F.try_validate_utf8(plain.cast("string")), c)


def encrypted(column: str | Column, key: bytes, iv: bytes) -> Column:
    """The inverse of ``decrypted``: base64 of the ciphertext without the vector."""
    c = F.col(column) if isinstance(column, str) else column
    message = F.aes_encrypt(c, F.lit(key), F.lit("CBC"), F.lit("PKCS"), F.lit(iv))
    return F.base64(F.substring(message, 17, 1 << 30))


def decrypt_columns(df: DataFrame, key: bytes, iv: bytes, columns: list[str] | None = None) -> DataFrame:
    """Decrypt the given columns, by default all text columns."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: decrypted(c, key, iv) for c in names})
