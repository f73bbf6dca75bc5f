"""Personal data: masking by column metadata, and a pattern scan for columns nobody tagged."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from feeloom.schemas import PII_KEY

# Formats of a UK national insurance number and of an email address.
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "nino": r"[A-CEGHJ-PR-TW-Z][A-CEGHJ-NPR-TW-Z] ?\d{2} ?\d{2} ?\d{2} ?[A-D]",
}


def pii_columns(schema: StructType) -> list[str]:
    """Columns tagged as personal data."""
    return [f.name for f in schema.fields if f.metadata.get(PII_KEY)]


def mask_pii(df: DataFrame, declared: StructType, how: str = "hash") -> DataFrame:
    """``df`` with the columns that ``declared`` tags replaced by a digest ('hash'), by x and n characters
    ('mask'), or left out ('drop')."""
    tagged = [c for c in pii_columns(declared) if c in df.columns]
    if how == "drop":
        return df.drop(*tagged)
    if how == "hash":
        return df.withColumns({c: F.sha2(F.col(c).cast("string"), 256) for c in tagged})
    if how == "mask":
        return df.withColumns({c: F.mask(F.col(c).cast("string")) for c in tagged})
    raise ValueError(f"how must be 'hash', 'mask' or 'drop', not {how!r}")


def keyed_digest(value: Column, secret: str) -> Column:
    """HMAC-SHA256 of the text of ``value`` in hexadecimal, from built-in digests; NULL stays NULL.

    Without ``secret`` nobody can list all values and compare digests. It is used up to its 64-byte block: a longer one is
    hashed first, as HMAC asks.
    """
    if not secret:
        raise ValueError("a keyed digest needs a secret")
    key = secret.encode()
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(b ^ pad for b in key)) for pad in (0x36, 0x5C))
    digest = F.sha2(F.concat(inner, value.cast("string").cast("binary")), 256)
    return F.sha2(F.concat(outer, F.unhex(digest)), 256)


def mask_pii_keyed(df: DataFrame, declared: StructType, secret: str) -> DataFrame:
    """``df`` with the columns that ``declared`` tags replaced by keyed digests: equal values stay equal under one secret.

    Keep the secret outside the warehouse and the plan's logs (pass it from a secret store); another secret gives
    digests that cannot be joined with these.
    """
    return df.withColumns({c: keyed_digest(F.col(c), secret) for c in pii_columns(declared) if c in df.columns})


def scan_for_pii(df: DataFrame, patterns: Mapping[str, str] = PII_PATTERNS) -> DataFrame:
    """(column_name, pattern, matching_rows) over every string column, from one aggregate pass."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    cells = [(c, p) for c in text for p in patterns]
    counts = df.agg(
        *[F.count_if(F.col(c).rlike(patterns[p])).alias(f"n{i}") for i, (c, p) in enumerate(cells)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"), F.lit(p).alias("pattern"), F.col(f"n{i}").alias("matching_rows")
            )
            for i, (c, p) in enumerate(cells)
        ]
    )
    return counts.select(F.inline(rows))
