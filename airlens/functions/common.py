"""Small scalar helpers shared by ingest, batch and sinks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_truthy(*cols) -> Column:
    """``a or b or c`` on strings: the first value that is neither NULL nor
    empty (the last argument is returned as is)."""
    parts = [F.nullif(_col(c), F.lit("")) for c in cols[:-1]] + [_col(cols[-1])]
    return F.coalesce(*parts)


def parse_iso_timestamp(text) -> Column:
    """ISO-8601 text -> TIMESTAMP, NULL on garbage (ANSI ``to_timestamp``
    would fail the whole job). Accepts ``Z``, offsets and fractions."""
    return F.try_to_timestamp(_col(text))


def iso_utc_string(ts) -> Column:
    """TIMESTAMP -> ``YYYY-MM-DDTHH:MM:SS.ffffffZ`` on the UTC clock."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def record_key(city="city", location_id="location_id") -> Column:
    """Partition key of a record: city, else a non-zero location id, else
    'unknown' (empty strings and 0 count as missing)."""
    loc = F.nullif(_col(location_id), F.lit(0)).cast("string")
    return F.coalesce(F.nullif(_col(city), F.lit("")), loc, F.lit("unknown"))
