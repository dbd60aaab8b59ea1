"""Column expressions: null handling, hashing, reshaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType, T.BooleanType)
DATETIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)

# What reads as a number; anything else in a numeric column is missing.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Strings longer than this are compared by a 256-bit digest, so that shuffles carry 32 bytes and
# not whole texts.
MAX_PLAIN_KEY_CHARS = 32


def q(name: str) -> Column:
    """Column by exact name, also when the name holds dots, spaces or quotes."""
    return F.col("`" + name.replace("`", "``") + "`")


def field_types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def present(name: str, dtype: T.DataType) -> Column:
    """The column with NaN read as missing."""
    return F.nanvl(q(name), F.lit(None)) if isinstance(dtype, FLOAT_TYPES) else q(name)


def as_double(name: str, dtype: T.DataType) -> Column:
    """Coerce to double; what cannot be read as a number becomes NULL."""
    if isinstance(dtype, FLOAT_TYPES):
        return F.nanvl(q(name).cast("double"), F.lit(None).cast("double"))
    if isinstance(dtype, T.StringType):
        return number_of(q(name))
    if is_numeric(dtype):
        return q(name).cast("double")
    return F.lit(None).cast("double")


def number_of(text: Column) -> Column:
    """The text as a double, NULL if it is not a plain number."""
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def distinct_key(name: str, dtype: T.DataType) -> Column:
    """Small value that is equal exactly where the column is equal."""
    col = present(name, dtype)
    if isinstance(dtype, T.StringType):
        return F.when(F.length(col) <= MAX_PLAIN_KEY_CHARS, col).otherwise(F.sha2(col, 256))
    return col


def row_hash(df: DataFrame, keys: list[str] | None = None, seed: int = 42) -> Column:
    """64-bit hash of the key columns (all columns if none are given); NULLs take part in it."""
    names = keys or df.columns
    parts = [p for n in names for p in (q(n), q(n).isNull())]
    return F.xxhash64(F.lit(seed), *parts)


def unit_interval(hash64: Column) -> Column:
    """Uniform number in [0, 1) from the upper 53 bits of a 64-bit hash."""
    return F.shiftrightunsigned(hash64, 11) * F.lit(2.0 ** -53)


def to_long(df: DataFrame, values: dict[str, Column], keep: list[str] = (),
            name: str = "name", value: str = "value") -> DataFrame:
    """Unpivot several expressions in one scan: one output row per input row and expression."""
    pairs = F.array(*[F.struct(F.lit(n).alias(name), e.alias(value)) for n, e in values.items()])
    kept = [q(k) for k in keep]
    return df.select(*kept, F.explode(pairs).alias("_pair")).select(*kept, "_pair.*")


def safe_name(text: str) -> str:
    """Column name without characters that need quoting."""
    return "".join(ch if ch.isalnum() or ch == "_" else "_" for ch in text)


def unique_name(wanted: str, taken: set[str]) -> str:
    """`wanted`, or `wanted_2`, `wanted_3`, ... if two levels clean up to the same name."""
    name, i = wanted, 2
    while name.lower() in taken:
        name, i = f"{wanted}_{i}", i + 1
    taken.add(name.lower())
    return name
