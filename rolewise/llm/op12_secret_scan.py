"""Secret scans by multipart credential linking: parts of credentials are found by pattern and joined within scopes.

Base spans (`assign`, `access`, `hex`) are always reported.  The method adds weak candidates: account names and mail
addresses (`identifier`), opaque runs and loosely named values (`secret`), addresses of services (`endpoint`).  A weak
candidate alone means nothing; it is reported when its complement lies within SCOPE characters of the same document:

- an identifier (weak, or a base `access`) and a secret (weak, a base `assign`, or a base `hex` with letters and digits)
  complete each other;
- an endpoint is reported beside a secret that has an identifier.

Everything is DataFrame functions.  Places of matches come from the lengths of the pieces between them (`split` and
`regexp_extract_all` cut a text alike), added up by a window over one document and kind; only lengths travel, no text
does.  Parts meet in an interval join: each is dealt to the CELL-wide stretches that it covers, secrets with their scope
on both sides, and joined on (document, stretch), so a document of any length is many small keys and pairs are only made
within a scope.

Spans count code points, ends are exclusive.  Null and empty texts have no span.  Repeated rows and repeated or null
doc_ids are separate documents.  Long texts: patterns have bounded beginnings, so work grows with the length.  Spans with
one start (ties) are listed in the order of KINDS.  An empty table gives an empty result.  Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .stage import staged, table

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
ASSIGN, ACCESS, HEX, IDENTIFIER, SECRET, ENDPOINT = range(6)
SCOPE = 200                 # characters between two parts of one credential
CELL = 512                  # width of the stretches that parts are dealt to


def either(words: str) -> str:
    """A pattern with its ASCII letters in either case; flags would also fold other letters in some engines."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


_TO = r"""["']?\x20*[:=]\x20*["']?"""
_KEYWORD = either("(password|passwd|secret|token|api_?key)")
_VALUE = r"[A-Za-z0-9+/_.=-]+"
_NAMED = either("(?:pwd|pass|passphrase|credentials?|private_?key|secret_?(?:access_?)?key|auth)") + _TO + r"""[^\x20\x09-\x0D"']{4,}"""
_ACCOUNT = either("(?:user_?(?:name|id)?|login|account|client_?id|access_?key(?:_?id)?)") + _TO + r"[A-Za-z0-9_.@+-]{3,64}"
_MAIL = r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
_ADDRESS = (r"""[A-Za-z][A-Za-z0-9+.-]{0,15}://[^\x20\x09-\x0D"'<>]{1,1000}"""
            r"|[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?")
PATTERNS = (_KEYWORD + _TO + f"({_VALUE})", "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}", f"{_ACCOUNT}|{_MAIL}",
            f"{_NAMED}|[A-Za-z0-9+/_=-]{{20,}}", _ADDRESS)
_NAMED_START = f"^{_NAMED}"


def _pieces(text: Column, kind: int) -> Column:
    """For each match of a kind: length of the text since the match before, own length, whether it counts, whether it
    has both letters and digits.  A run of 18 (16) or more is found by a pattern that asks for as many: a shorter run
    has no such match, and a longer one begins and ends alike."""
    pattern = F.lit(PATTERNS[kind])
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, PATTERNS[kind], -1)
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]")
    counts = {ASSIGN: lambda m: F.length(F.regexp_extract(m, PATTERNS[ASSIGN], 2)) >= 12,
              SECRET: lambda m: m.rlike(_NAMED_START) | mixed(m)}.get(kind, lambda m: F.lit(True))
    return F.when(F.size(whole) > 0, F.transform(F.arrays_zip(whole.alias("m"), F.slice(between, 1, F.size(whole)).alias("g")), lambda p: F.struct(
        F.lit(kind).alias("kind"), F.length(p["g"]).alias("gap"), F.length(p["m"]).alias("len"), counts(p["m"]).alias("counts"),
        mixed(p["m"]).alias("mixed")))).otherwise(F.array())


def _cells(parts: DataFrame, reach: int, side: str) -> DataFrame:
    low, high = F.floor((F.col("start") - reach) / CELL), F.floor((F.col("end") - 1 + reach) / CELL)
    return parts.select("row", F.col("kind").alias(f"{side}_kind"), F.col("start").alias(f"{side}_start"), F.col("end").alias(f"{side}_end"),
                        low.alias(f"{side}_cell"), F.explode(F.sequence(low, high)).alias("cell"))


def near(left: DataFrame, right: DataFrame, reach: int) -> DataFrame:
    """Pairs of spans (row, kind, start, end) of one document with fewer than `reach` characters between them, each once."""
    pairs = _cells(left, reach, "a").join(_cells(right, 0, "b"), ["row", "cell"]).filter(
        (F.col("a_start") - reach < F.col("b_end")) & (F.col("b_start") < F.col("a_end") + reach)
        & (F.col("cell") == F.greatest("a_cell", "b_cell")))         # the first stretch that both cover
    return pairs.drop("cell", "a_cell", "b_cell")


def spans(docs: DataFrame) -> DataFrame:
    """Candidates of all kinds, written: row, doc_id, kind (number in KINDS), start, end, counts, mixed.

    A document without any match is a row with nulls from `kind` on."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.concat(*[_pieces(F.col("text"), k) for k in range(len(KINDS))]).alias("pieces")))
    listed = found.filter(F.size("pieces") > 0).select("row", "doc_id", F.posexplode("pieces").alias("i", "p")).select("row", "doc_id", "i", "p.*")
    before = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = listed.repartition("row").withColumn("end", F.sum(F.col("gap") + F.col("len")).over(before).cast("int")).select(
        "row", "doc_id", "kind", (F.col("end") - F.col("len")).alias("start"), "end", "counts", "mixed")
    none = found.filter(F.size("pieces") == 0).select("row", "doc_id")
    return staged(placed.unionByName(none, allowMissingColumns=True))


def links(found: DataFrame) -> DataFrame:
    """Credentials: row, secret (a_kind, a_start, a_end) and a part that completes it (b_kind, b_start, b_end)."""
    kept = found.filter("counts")
    weak = kept.filter(F.col("kind") == SECRET)
    base = kept.filter(F.col("kind") <= HEX)
    covered = near(weak, base, 0).select("row", F.col("a_start").alias("start"), F.lit(SECRET).alias("kind")).distinct()
    secrets = kept.filter((F.col("kind") == ASSIGN) | ((F.col("kind") == HEX) & F.col("mixed"))).unionByName(
        weak.join(covered, ["row", "kind", "start"], "left_anti"))
    named = staged(near(secrets, kept.filter(F.col("kind").isin(ACCESS, IDENTIFIER)), SCOPE))
    whole = named.select("row", F.col("a_kind").alias("kind"), F.col("a_start").alias("start"), F.col("a_end").alias("end")).distinct()
    return named.unionByName(near(whole, kept.filter(F.col("kind") == ENDPOINT), SCOPE))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, n_links (pairs of a secret and another part) and spans, for each row of docs."""
    found = spans(docs)
    linked = staged(links(found))
    weak = linked.select("row", F.inline(F.array(*[F.struct(F.col(f"{s}_kind").alias("kind"), F.col(f"{s}_start").alias("start")) for s in "ab"]))).filter(
        F.col("kind") >= IDENTIFIER).distinct().withColumn("linked", F.lit(True))
    told = found.join(weak, ["row", "kind", "start"], "left").withColumn("base", F.col("counts") & (F.col("kind") <= HEX))
    n_links = linked.groupBy("row").agg(F.count(F.lit(1)).alias("n_links"))
    names = F.array(*map(F.lit, KINDS))
    text = lambda base: F.array_join(F.transform(F.filter("all", lambda s: s["base"] | ~F.lit(base)), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    per_row = told.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sort_array(F.collect_list(F.when(F.col("base") | F.col("linked"), F.struct("start", "kind", "end", "base")))).alias("all"))
    return per_row.join(n_links, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(text(True), 256).alias("base_sha256"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        text(False).alias("spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def _sql() -> str:
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    mixed = "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')"
    counts = {ASSIGN: f"length(regexp_extract(m, {quoted(PATTERNS[ASSIGN])}, 2)) >= 12", SECRET: f"regexp_matches(m, {quoted(_NAMED_START)}) OR ({mixed})"}
    kinds = "\nUNION ALL ".join(
        f"SELECT id, {k} AS kind, start, start + length(m) AS stop, {counts.get(k, 'true')} AS counts, {mixed} AS mixed FROM "
        f"(SELECT id, m, sum(length(g) + length(m)) OVER (PARTITION BY id ORDER BY i) - length(m) AS start FROM "
        f"(SELECT id, unnest(regexp_extract_all(t, {quoted(p)})) AS m, unnest(regexp_split_to_array(t, {quoted(p)})) AS g, "
        f"unnest(range(length(t) + 2)) AS i FROM d WHERE regexp_matches(t, {quoted(p)})) WHERE m IS NOT NULL)" for k, p in enumerate(PATTERNS))
    near = lambda reach: f"a.id = b.id AND a.start - {reach} < b.stop AND b.start < a.stop + {reach}"
    listed = lambda only: ("coalesce(string_agg(" + "CASE kind " + " ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(KINDS))
                           + f" END || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, kind) FILTER ({only}), '')")
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
f AS MATERIALIZED (SELECT * FROM ({kinds}) WHERE counts),
s AS MATERIALIZED (SELECT * FROM f a WHERE kind = 0 OR (kind = 2 AND mixed)
  OR (kind = 4 AND NOT EXISTS (SELECT 1 FROM f b WHERE b.kind <= 2 AND {near(0)}))),
l AS MATERIALIZED (SELECT a.id, a.kind AS ak, a.start AS s, b.kind AS bk, b.start AS bs FROM s a JOIN f b ON {near(SCOPE)} WHERE b.kind IN (1, 3)),
e AS (SELECT a.id, a.kind, a.start, b.kind AS bk, b.start AS bs FROM s a JOIN f b ON {near(SCOPE)} WHERE b.kind = 5
  AND EXISTS (SELECT 1 FROM l WHERE l.id = a.id AND l.ak = a.kind AND l.s = a.start)),
p AS MATERIALIZED (SELECT * FROM l UNION ALL SELECT * FROM e),
w AS (SELECT DISTINCT id, k, s FROM (SELECT id, ak AS k, s FROM p UNION ALL SELECT id, bk, bs FROM p) WHERE k >= 3),
r AS (SELECT f.id, f.kind, f.start, f.stop, f.kind <= 2 AS base FROM f LEFT JOIN w ON w.id = f.id AND w.k = f.kind AND w.s = f.start
  WHERE f.kind <= 2 OR w.id IS NOT NULL),
g AS (SELECT id, {', '.join(f"count(*) FILTER (kind = {k}) AS n_{KINDS[k]}" for k in range(3))}, {listed('base')} AS base, {listed('true')} AS spans FROM r GROUP BY id),
n AS (SELECT id, count(*) AS n_links FROM p GROUP BY id)
SELECT doc_id, {', '.join(f"coalesce(n_{KINDS[k]}, 0) AS n_{KINDS[k]}" for k in range(3))}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(n_links, 0) AS n_links, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (id) LEFT JOIN n USING (id)
"""


SQL = _sql()
