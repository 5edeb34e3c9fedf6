"""Keys of new rows, computed from what the row is about, so a re-run makes the same ones."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, StringType


def derived_key(data_type: DataType, *parts: Column | str) -> Column:
    """GUID-shaped text for text keys, a 64-bit hash for number keys.

    Text keys carry 128 bits and are the right choice for large tables.
    """
    columns = [F.col(part) if isinstance(part, str) else part for part in parts]
    if not isinstance(data_type, StringType):
        return F.xxhash64(*columns).cast(data_type)
    text = F.concat_ws("|", *(F.coalesce(column.cast("string"), F.lit("")) for column in columns))
    digest = F.sha2(text, 256)
    pieces = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.upper(F.concat_ws("-", *(F.substring(digest, start, size) for start, size in pieces)))
