"""Column protection: masking, encryption, pseudonyms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from strata.functions import text
from strata.operators.plan import computed_once

KEYS = "key_id string, key binary"


def mask_columns(df: DataFrame, columns: Sequence[str], mask_char: str = "*", visible_chars: int = 3) -> DataFrame:
    return df.withColumns({c: text.mask_pii(F.col(c), mask_char, visible_chars) for c in columns})


def mask_text_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: text.mask_pii_in_text(F.col(c)) for c in columns})


def _with_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows with the key that their ``key_id`` names. Keys travel as rows, so no plan, page or event log shows one."""
    return df.join(keys.select(F.col("key_id"), F.col("key").alias("_key")), "key_id", "left").withColumn(
        "_key", F.coalesce("_key", F.raise_error(F.concat(F.lit("no key "), F.coalesce("key_id", F.lit("NULL")))).cast("binary")))


def encrypt_columns(df: DataFrame, columns: Sequence[str], keys: DataFrame, key_id: str) -> DataFrame:
    """AES-GCM with a random nonce, as base64 text, and ``key_id`` beside it. NULL stays NULL; an unknown key raises.

    ``keys`` has ``key_id`` and ``key`` (16, 24 or 32 bytes), one row each, from a path that only this job may read.
    """
    # The id as a value of each row: as a constant it would turn the join into one without a condition.
    out = _with_keys(computed_once(df, F.struct(F.lit(key_id).alias("key_id"))), keys)
    return out.withColumns({c: F.base64(F.aes_encrypt(F.col(c), F.col("_key"), F.lit("GCM"))) for c in columns}).drop("_key")


def decrypt_columns(df: DataFrame, columns: Sequence[str], keys: DataFrame) -> DataFrame:
    """Decrypt by the key that each row names, so rows of old and new keys can stand side by side."""
    out = _with_keys(df, keys)
    return out.withColumns({c: F.aes_decrypt(F.unbase64(F.col(c)), F.col("_key"), F.lit("GCM")).cast("string")
                            for c in columns}).drop("_key", "key_id")


def pseudonymize_columns(df: DataFrame, columns: Sequence[str] | Mapping[str, str], salt: str | None = None) -> DataFrame:
    """SHA-256 of the values; a salt keeps outsiders from trying candidate values."""
    salted = F.lit(salt) if salt is not None else None
    return df.withColumns({c: text.pseudonym(F.col(c), salted) for c in columns})
