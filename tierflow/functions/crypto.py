"""Column encryption: AES with PKCS padding, stored as base64 text.

GCM is the default; it salts each value. ECB is deterministic, so that encrypted columns stay joinable.
A caller may instead name a pair of SQL functions; those get the text and return text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.project import trim_names


PADDING = {"GCM": "DEFAULT"}


def _nested(dtype: str) -> bool:
    return any(word in dtype.lower() for word in ("array", "struct", "map"))


def _targets(df: DataFrame, pii: dict[str, str | None]) -> dict[str, str]:
    """Columns to treat, spelled as in the data. Unknown columns and NULL types are skipped."""
    wanted = {name.lower(): dtype for name, dtype in (pii or {}).items() if dtype is not None}
    return {c: wanted[c.lower()] for c in df.columns if c.lower() in wanted}


class Cipher:
    """Either a key with a mode, or the names of two SQL functions."""

    def __init__(
        self,
        key: Column | str | bytes | None = None,
        mode: str = "GCM",
        encrypt_function: str | None = None,
        decrypt_function: str | None = None,
    ):
        if key is None and not (encrypt_function or decrypt_function):
            raise ValueError("a cipher needs a key or SQL function names")
        self.key = key
        self.mode = mode
        self.encrypt_function = encrypt_function
        self.decrypt_function = decrypt_function

    def _settings(self) -> tuple[Column, Column, Column]:
        """Key, mode and padding as columns; GCM knows no padding."""
        key = self.key if isinstance(self.key, Column) else F.lit(self.key)
        return key, F.lit(self.mode), F.lit(PADDING.get(self.mode, "PKCS"))

    def encrypt(self, text: Column) -> Column:
        if self.encrypt_function:
            return F.call_function(self.encrypt_function, text)
        return F.base64(F.aes_encrypt(text, *self._settings()))

    def decrypt(self, text: Column) -> Column:
        if self.decrypt_function:
            return F.call_function(self.decrypt_function, text).cast("string")
        return F.aes_decrypt(F.unbase64(text), *self._settings()).cast("string")


def encrypt_columns(df: DataFrame, pii: dict[str, str | None], cipher: Cipher) -> DataFrame:
    df = trim_names(df)
    todo = _targets(df, pii)
    if not todo:
        return df
    texts = {c: F.to_json(F.col(f"`{c}`")) if _nested(t) else F.col(f"`{c}`").cast("string") for c, t in todo.items()}
    return df.withColumns({c: cipher.encrypt(text) for c, text in texts.items()})


def decrypt_columns(df: DataFrame, pii: dict[str, str | None], cipher: Cipher) -> DataFrame:
    todo = _targets(df, pii)
    if not todo:
        return df
    plain = {c: cipher.decrypt(F.col(f"`{c}`")) for c in todo}
    return df.withColumns({c: F.from_json(plain[c], t) if _nested(t) else plain[c].cast(t) for c, t in todo.items()})


def with_decrypted(
    df: DataFrame, pii: dict[str, str | None], cipher: Cipher | None, transform: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Transform in clear text, store encrypted again."""
    if not pii or cipher is None:
        return transform(df)
    return encrypt_columns(transform(decrypt_columns(df, pii, cipher)), pii, cipher)


def register_cipher_functions(
    spark: SparkSession, key_sql: str, encrypt_name: str = "encrypt_text", decrypt_name: str = "decrypt_text",
    mode: str = "ECB",
) -> None:
    """SQL functions of text to text; ``key_sql`` is the SQL expression that yields the key."""
    padding = PADDING.get(mode, "PKCS")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {encrypt_name}(val STRING) RETURNS STRING "
        f"RETURN base64(aes_encrypt(val, {key_sql}, '{mode}', '{padding}'))"
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {decrypt_name}(val STRING) RETURNS STRING "
        f"RETURN CAST(aes_decrypt(unbase64(val), {key_sql}, '{mode}', '{padding}') AS STRING)"
    )
