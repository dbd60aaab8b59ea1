"""Input tables: Parquet, or CSV whose encoding and types are found from the data."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import NUMBER_PATTERN, q
from ..functions.tables import hash_sample, staged
from .records import LATIN, WINDOWS, records, splits

# Fixed texts that mean "missing" in a CSV field.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
           "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
INTEGER_PATTERN = r"^\s*[+-]?\d{1,18}\s*$"
LONG_INTEGER_PATTERN = r"^\s*[+-]?\d{1,38}\s*$"      # ids beyond bigint keep their digits
EXCEL = (".xls", ".xlsx")
def load_table(spark: SparkSession, path: str, filename: str | None = None) -> DataFrame:
    """Read a file, a folder or a glob; the suffix of `filename` (or the path) gives the format."""
    suffix = PurePosixPath(str(filename or path).rstrip("/*")).suffix.lower()
    if suffix in EXCEL:
        raise ValueError("Excel files are not read; export the sheet as CSV or Parquet")
    return spark.read.parquet(path) if suffix == ".parquet" else read_csv(spark, path)


def csv_facts(spark: SparkSession, path: str) -> dict[str, object]:
    """Encoding and quoting of a CSV file from one scan over its raw lines; of a folder, those of all files together."""
    return _facts(splits(spark, path))


def _facts(found: DataFrame) -> dict[str, object]:
    row = found.agg(F.collect_set("encoding").alias("encodings"), F.sum("opened").alias("opened")).first()
    kinds = row["encodings"] or ["utf-8"]                       # three at most
    return {"encoding": next(e for e in ("latin-1", "cp1252", "utf-8") if e in kinds), "multi_line": bool(row["opened"]), "mixed": len(kinds) > 1}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header: each file UTF-8, else Windows-1252, else Latin-1; types from all values.

    Files are read in splits.  Where no quoted field holds a line break, a line is a record; else, and where the files'
    charsets differ, `records` cuts the records.
    """
    found = staged(splits(spark, path))
    facts = _facts(found)
    if facts["multi_line"] or facts["mixed"]:
        text = _from_records(records(spark, path, found))
    else:
        text = _from_lines(spark, path, str(facts["encoding"]))
    return _typed(text.select(*[F.when(~q(c).isin(*MISSING), q(c)).alias(c) for c in text.columns]))


def _from_lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    raw = (spark.read.option("header", True).option("escape", '"').option("mode", "PERMISSIVE")
           .option("encoding", "UTF-8" if encoding == "utf-8" else "ISO-8859-1").csv(path))
    names = raw.columns
    if names:
        names[0] = names[0].removeprefix("\ufeff").strip('"')
    if encoding == "cp1252":
        names = [n.translate(str.maketrans(LATIN, WINDOWS)) for n in names]
        raw = raw.select(*[F.translate(q(c), LATIN, WINDOWS).alias(c) for c in raw.columns])
    return raw.toDF(*names)


def _from_records(found: DataFrame) -> DataFrame:
    """Fields of the records; the names are those of the first file by name."""
    head = found.filter("first").orderBy("file").select("text").first()
    options = {"escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "maxCharsPerColumn": "-1"}
    width = head["text"].count(",") + 1 if head else 0                # names at most
    if not width:
        return found.select()
    schema = lambda n: ", ".join(f"c{i} string" for i in range(n))
    spark = found.sparkSession
    names = spark.createDataFrame([(head["text"],)], "t string").select(F.from_csv("t", schema(width), options).alias("r")).select("r.*").first()
    last = max(i for i, n in enumerate(names) if n is not None or not i) + 1
    # Empty and repeated names get what Spark's reader gives them.
    plain = [n if n else f"_c{i}" for i, n in enumerate(names[:last])]
    plain = [f"{n}{i}" if [m.lower() for m in plain].count(n.lower()) > 1 else n for i, n in enumerate(plain)]
    return found.filter(~F.col("first")).select(F.from_csv("text", schema(last), options).alias("r")).select("r.*").toDF(*plain)


def _typed(text: DataFrame) -> DataFrame:
    """Whole numbers, numbers and booleans become such; every other column stays text."""
    names = text.columns
    if not names:
        return text
    tests = {"long": INTEGER_PATTERN, "decimal(38,0)": LONG_INTEGER_PATTERN, "double": NUMBER_PATTERN, "boolean": "^(True|False|TRUE|FALSE|true|false)$"}
    row = text.agg(*[F.bool_and(q(c).rlike(p)).alias(f"{t}{i}") for i, c in enumerate(names)
                     for t, p in tests.items()]).first()
    return text.select(*[next((F.trim(q(c)).cast(t).alias(c) for t in tests if row[f"{t}{i}"]), q(c))
                         for i, c in enumerate(names)])


def peek(df: DataFrame) -> DataFrame:
    """Column names and types with the row and column counts."""
    n = df.count()
    rows = [(i, c, t, n, len(df.columns)) for i, (c, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(
        rows, "position int, name string, dtype string, n_rows long, n_cols int")


def preview(df: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    """The first n rows in key order."""
    return df.orderBy(*[q(k) for k in keys]).limit(n)


def sample_rows(df: DataFrame, n: int, keys: list[str] | None = None, seed: int = 42) -> DataFrame:
    """Exactly n rows (all if there are fewer), the same for any partitioning."""
    return hash_sample(df, n, keys, seed)
