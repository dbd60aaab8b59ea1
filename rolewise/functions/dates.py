"""Date strings: which texts count as a date and what instant they mean."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# Accepted layouts, each behind a pattern so that free text never reaches the parser.
_ISO = r"^\s*\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})?)?\s*$"
_LAYOUTS = [
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "y/M/d"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}$", "y/M/d H:mm:ss"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/y"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", "M/d/y H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", "M/d/y H:mm:ss"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-y"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM y"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, y"),
    (r"^(19|20)\d{6}$", "yyyyMMdd"),
]
MAX_LENGTH = 40            # no accepted layout is longer, so longer texts are not looked at
NAME_HINT = r"(?i)(date|time|_at$|_dt$|year|month|day)"


def parse_timestamp(col: Column, dtype: T.DataType) -> Column:
    """Wall-clock timestamp of a date, timestamp or date-like string column; NULL if it is none."""
    if not isinstance(dtype, T.StringType):
        return col.cast("timestamp_ntz")
    text = F.trim(col)
    options = [F.when(text.rlike(_ISO), text.try_cast("timestamp_ntz"))]
    for pattern, layout in _LAYOUTS:
        options.append(F.when(text.rlike(pattern),
                              F.try_to_timestamp(text, F.lit(layout)).cast("timestamp_ntz")))
    return F.when(F.length(text) <= MAX_LENGTH, F.coalesce(*options))
