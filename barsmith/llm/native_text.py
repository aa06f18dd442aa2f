"""Text expressions of built-in functions, and the size check before a broadcast."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What `lower` may change beyond A-Z: upper and title case, and code points unknown to the regular
#: expressions, whose tables can be older than those of `lower`.
_OTHER_CAPITALS = r"[\p{IsUppercase}\p{Lt}\p{Cn}&&[^A-Z]]"


def ascii_lower(text: Column) -> Column:
    """The text with A-Z in lower case and nothing else changed; null stays null.

    `lower` is a fast byte loop but changes capitals of all scripts. It is used where there are
    none: for ASCII texts, and texts without another capital. The rest goes through `translate`.
    """
    return F.when((F.octet_length(text) == F.char_length(text)) | ~text.rlike(_OTHER_CAPITALS), F.lower(text)) \
        .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def small(table: DataFrame, most_bytes: int = 32 << 20) -> DataFrame:
    """The stored table, marked for broadcast if its values take few bytes; else joins go by key."""
    width = F.lit(16)
    for name, kind in table.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith("array"):
            width = width + 160 * F.coalesce(F.size(name), F.lit(0))
        else:
            width = width + 16
    size = table.agg(F.sum(width.cast("long")).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(table) if size <= most_bytes else table
