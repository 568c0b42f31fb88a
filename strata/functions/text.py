"""String column expressions: trimming, canonical row text and hashes, masking."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Unicode white space at either end of a string.
TRIM_PATTERN = r"(?U)^\s+|\s+\z"

# Personal data inside running text.
EMAIL_PATTERN = r"([A-Za-z0-9._%+-]{1,3}+)[A-Za-z0-9._%+-]*+@([A-Za-z0-9])[A-Za-z0-9.-]*\.[A-Za-z]{2,}"
SSN_PATTERN = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"
PHONE_PATTERN = r"(\+[0-9]{1,3}[ .-]?)?(\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}\b"


def trim_unicode(col: Column) -> Column:
    """Strip white space at both ends. ``F.trim`` removes the space character only."""
    return F.regexp_replace(col, TRIM_PATTERN, "")


def canonical_text(col: Column, dtype: T.DataType) -> Column:
    """Text of one value that does not depend on session settings; NULL stays NULL."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(col)
    if isinstance(dtype, T.BinaryType):
        return F.hex(col)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col).cast("string")
    return col.cast("string")


def record_hash(schema: T.StructType, exclude: tuple[str, ...] = ()) -> Column:
    """md5 of a row. Columns go in name order, so column order does not matter.

    Each value is written as ``name=length:text``; the length keeps two different rows from giving one text, and
    a NULL (``name=~``) differs from every string.
    """
    parts = []
    for field in sorted((f for f in schema.fields if f.name not in exclude), key=lambda f: f.name):
        text = canonical_text(F.col(f"`{field.name}`"), field.dataType)
        tagged = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.concat(F.lit(f"{field.name}="), F.coalesce(tagged, F.lit("~"))))
    return F.md5(F.concat_ws("|", *parts))


def mask_pii(col: Column, mask_char: str = "*", visible_chars: int = 3) -> Column:
    """Hide the middle of a value.

    Short values are masked whole, an address keeps ``joh***@e***``, anything else keeps both ends.
    """
    if visible_chars < 0:
        raise ValueError("visible_chars must not be negative")
    stars = mask_char * 3
    at = F.split(col, "@")
    is_email = (F.size(at) == 2) & (F.length(at[1]) > 0)
    head = F.substring(col, 1, visible_chars)
    tail = F.right(col, F.lit(visible_chars))
    return (
        F.when(F.length(col) <= 2 * visible_chars, F.repeat(F.lit(mask_char), F.length(col)))
        .when(is_email, F.concat(F.substring(at[0], 1, visible_chars), F.lit(f"{stars}@"),
                                 F.substring(at[1], 1, 1), F.lit(stars)))
        .when(col.isNotNull(), F.concat(head, F.lit(stars), tail))
    )


def mask_pii_in_text(col: Column) -> Column:
    """Mask every e-mail address, social security number and phone number inside a text."""
    # Most texts hold no address: a plain search for the sign spares them the costly pattern.
    masked = F.when(F.contains(col, F.lit("@")), F.regexp_replace(col, EMAIL_PATTERN, "$1***@$2***")).otherwise(col)
    masked = F.regexp_replace(masked, SSN_PATTERN, "***-**-****")
    return F.regexp_replace(masked, PHONE_PATTERN, "***-***-****")


def pseudonym(col: Column, salt: Column | None = None) -> Column:
    """SHA-256 of a value: equal values stay joinable, the value itself does not survive."""
    text = col.cast("string")
    return F.sha2(F.concat(salt, text) if salt is not None else text, 256)
