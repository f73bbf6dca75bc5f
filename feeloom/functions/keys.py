"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = chr(31)
NULL_MARK = chr(30)


def surrogate_key(*columns: Column | str) -> Column:
    """md5 over the text of ``columns``. NULL hashes as its own mark, since concat_ws would skip it."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *[F.coalesce(p.cast("string"), F.lit(NULL_MARK)) for p in parts]))


def fee_key(scale: int = 2) -> Column:
    """Key of one fee. The amount is hashed as decimal text: the text of a double differs between engines."""
    return surrogate_key(
        "client_id", "adviser_id", "fee_date", F.col("fee_amount").cast(f"decimal(18,{scale})")
    )
