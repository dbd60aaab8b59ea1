"""Merkle manifest of a dataset: a root over all rows, a proof for each, most nodes recomputed when they are asked for.

A leaf is H (lowercase hex SHA-256) of a row's fields, each `-` if null, else byte count, `:`, value.  Leaves of a group
(lang) stand in the order of the key (doc_id); FANOUT consecutive nodes become the H of their joined digests, level by
level, until one is left.  The groups' roots, in the order of the groups (null first), are the leaves of one more tree.

Checkpoint and recompute: the manifest keeps the leaves and every STRIDE-th level only.  `proofs` takes each aligned
subtree of FANOUT^STRIDE stored nodes, computes its missing levels again, adds each row's siblings to the path of the
subtree's own root, and keeps nothing of them.  A subtree is one row of at most 512 digests, so no task holds a group,
and a group that holds most rows is many subtrees.  Positions come from a dealing by range (`numbering`).

`fold` recomputes a root from a leaf and its path, so a changed row shows.

Rows may repeat and keys may tie or be null (null first): rows of one key stand in the order of their digests, so the
result does not depend on how the table is cut.  Texts of any length are one digest each.  An empty table has no leaf,
no root and an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .numbering import numbered
from .stage import discard, shards, staged, table

FANOUT = 8
STRIDE = 3                  # levels from one stored level to the next
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PER_SHARD = 500_000         # leaves for each partition of the dealing by range
_STEP = "array<struct<left:string,right:string>>"


def digest(*fields: Column) -> Column:
    """H of the fields, each with its length, so no two rows of fields are written alike."""
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-"))
                             for f in (c.cast("string") for c in fields)]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to along its path."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def siblings(path: Column) -> Column:
    """All digests of a path, joined in its order."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def _let(value: Column, use) -> Column:
    """use(value), with value computed once for each row; a plain column would be inlined into each lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _run(nodes: Column, number: Column) -> Column:
    return F.slice(nodes, number * FANOUT + 1, F.lit(FANOUT))


def _parents(nodes: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int")), lambda i: F.sha2(F.array_join(_run(nodes, i), ""), 256))


def _levels(nodes: Column, n: Column, use, made: tuple = ()) -> Column:
    """use(levels) for the levels of a subtree, from its stored nodes up.  `n` counts the nodes of the whole tree on the
    stored level: where it is down to one before the subtree is, the levels above are the same single node."""
    made = (*made, nodes)
    if len(made) > STRIDE:
        return use(made)
    more = F.ceil(n / FANOUT ** (len(made) - 1)) > 1
    return _let(F.when(more, _parents(nodes)).otherwise(nodes), lambda up: _levels(up, n, use, made))


def _root(nodes: Column, n: Column) -> Column:
    return _levels(nodes, n, lambda levels: F.element_at(levels[-1], 1))


def _paths(items: Column, n: Column, above: Column) -> Column:
    """The items of a subtree, each with the path to its tree's root: the siblings of each level, then the path of the subtree's root."""
    def step(level: Column, k: int, i: Column) -> Column:
        at = F.floor(i / FANOUT ** k).cast("int")
        run, place = _run(level, F.floor(at / FANOUT).cast("int")), at % FANOUT
        return F.struct(F.array_join(F.slice(run, F.lit(1), place), "").alias("left"),
                        F.array_join(F.slice(run, place + 2, F.lit(FANOUT)), "").alias("right"))

    def use(levels: tuple) -> Column:
        def one(item: Column, i: Column) -> Column:
            steps = F.array(*[F.when(F.ceil(n / FANOUT ** k) > 1, step(levels[k], k, i)) for k in range(STRIDE)])
            return F.struct(item.alias("item"), F.concat(F.filter(steps, lambda s: s.isNotNull()), above).alias("path"))
        return F.transform(items, one)
    return _levels(items["digest"], n, use)


@dataclass
class Tree:
    """levels: the stored ones, from the leaves up, a row for each aligned subtree (grp, block, n, items in order);
    roots: grp, root, single (it is a leaf too)."""
    levels: list[DataFrame]
    roots: DataFrame


def _blocks(nodes: DataFrame, carry: tuple = ()) -> DataFrame:
    """Nodes (grp, pos, n, digest) as rows of up to FANOUT^STRIDE neighbours."""
    item = F.struct("pos", "digest", *carry)
    return nodes.groupBy("grp", F.floor(F.col("pos") / FANOUT ** STRIDE).cast("long").alias("block")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(item)).alias("items"))


def tree(leaves: DataFrame, order: list[Column], carry: tuple = ()) -> Tree:
    """Trees over rows (grp, digest, carried columns): one for each grp, leaves in the order given, then by digest."""
    n_parts = shards(leaves.sparkSession, leaves.count(), PER_SHARD)
    levels = [staged(_blocks(numbered(leaves, "grp", [*order, F.col("digest")], n_parts), carry))]
    while True:
        tops = levels[-1].select("grp", F.col("block").alias("pos"), "n", _root(F.col("items")["digest"], F.col("n")).alias("digest"))
        if not tops.filter(F.col("n") > FANOUT ** STRIDE).limit(1).count():
            break
        above = tops.filter(F.col("n") > FANOUT ** STRIDE).withColumn("n", F.ceil(F.col("n") / FANOUT ** STRIDE).cast("long"))
        levels.append(staged(_blocks(above)))
    roots = None
    for level in levels:
        found = level.filter(F.col("n") <= FANOUT ** STRIDE).select("grp", _root(F.col("items")["digest"], F.col("n")).alias("root"))
        roots = found if roots is None else roots.unionByName(found)
    return Tree(levels, staged(roots))


def paths(built: Tree, above: DataFrame) -> DataFrame:
    """The leaves' rows (grp, item, path), the path continued by that of the group's root: `above` has grp, path."""
    for k in range(len(built.levels) - 1, -1, -1):
        level = built.levels[k]
        ends = above.select(F.col("grp").alias("_grp"), F.lit(0).cast("long").alias("_block"), F.lit(True).alias("_root"), F.col("path").alias("above"))
        if k < len(built.levels) - 1:
            ends = ends.unionByName(inner.select(F.col("grp").alias("_grp"), F.col("item.pos").alias("_block"), F.lit(False).alias("_root"),
                                                 F.col("path").alias("above")))
        met = level.join(ends, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("block") == F.col("_block"))
                         & ((F.col("n") <= FANOUT ** STRIDE) == F.col("_root")))
        inner = met.select("grp", F.inline(_paths(F.col("items"), F.col("n"), F.col("above"))))
    return inner


def manifest(rows: DataFrame, order: list[Column], carry: tuple = ()) -> tuple[Tree, Tree]:
    """The trees of the groups and the tree of their roots.  Rows: grp, digest, carried columns."""
    groups = tree(rows, order, carry)
    return groups, tree(groups.roots.select(F.lit(0).alias("grp"), F.col("root").alias("digest"), F.col("grp").alias("name")),
                        [F.encode("name", "utf-8").asc_nulls_first()], ("name",))


def proofs(groups: Tree, top: Tree) -> DataFrame:
    """grp, item (digest and carried columns), path to the one root, subroot and root, for each leaf."""
    first = F.lit(None).cast(_STEP)
    outer = staged(paths(top, top.roots.select("grp", F.coalesce(first, F.array().cast(_STEP)).alias("path"))).select(
        F.col("item.name").alias("grp"), "path"))
    whole = top.roots.first()                                  # none for an empty table
    known = groups.roots.select(F.col("grp").alias("_grp"), F.col("root").alias("subroot"), F.lit(whole and whole["root"]).alias("root"))
    found = paths(groups, outer)
    return found.join(known, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")


def checked(docs: DataFrame, changed: Column, change: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified, for each row of docs.  Where `changed`, the
    leaf that is folded is that of the row with `change` as its text."""
    named = docs.select(*FIELDS)
    leaf = digest(*[F.col(f) for f in FIELDS])
    other = F.when(changed, digest(*[change if f == "text" else F.col(f) for f in FIELDS]))
    leaves = named.select(F.col("lang").cast("string").alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("digest"), other.alias("other"))
    leaves = staged(leaves)
    groups, top = manifest(leaves, [F.col("doc_id").asc_nulls_first()], ("doc_id", "other"))
    discard(leaves)
    told = proofs(groups, top).select(
        F.col("item.doc_id").alias("doc_id"), F.col("item.digest").alias("leaf"), "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        fold(F.coalesce("item.other", "item.digest"), F.col("path")).alias("folded_root"))
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *FIELDS)
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return checked(docs, changed, F.translate("text", string.ascii_uppercase, string.ascii_lowercase))


def _sql() -> str:
    """The same trees level by level, no checkpoints; crc32 from its table, which follows from the polynomial."""
    field = lambda f: f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(text if f == "text" else f) for f in FIELDS) + ")"
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

    def built(name: str, first: str) -> str:
        return f"""
{name} AS (SELECT 0 AS lvl, g, pos, h, n FROM ({first})
  UNION ALL SELECT lvl + 1, g, pos // {FANOUT}, sha256(string_agg(h, '' ORDER BY pos)), (n + {FANOUT - 1}) // {FANOUT}
  FROM {name} WHERE n > 1 GROUP BY lvl, g, pos // {FANOUT}, n),
{name}_beside AS MATERIALIZED (SELECT lvl, g, pos, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name} WHERE n > 1
  WINDOW w AS (PARTITION BY lvl, g, pos // {FANOUT} ORDER BY pos))"""

    def walked(name: str, tree: str, first: str) -> str:
        return f"""
{name} AS (SELECT id, g, 0 AS lvl, pos, proof, f FROM ({first})
  UNION ALL SELECT w.id, w.g, w.lvl + 1, w.pos // {FANOUT}, w.proof || b.l || b.r, sha256(b.l || w.f || b.r)
  FROM {name} w JOIN {tree}_beside b ON b.lvl = w.lvl AND b.g = w.g AND b.pos = w.pos),
{name}_end AS (SELECT id, g, arg_max(proof, lvl) AS proof, arg_max(f, lvl) AS f FROM {name} GROUP BY id, g)"""

    return f"""
WITH RECURSIVE crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g, {leaf('text')} AS leaf, {leaf(lower)} AS other,
  coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 3 = 0, false) AS changed FROM documents, crc),
p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d),
{built('nodes', 'SELECT g, pos, leaf AS h, n FROM p')},
subroots AS MATERIALIZED (SELECT g, h FROM nodes WHERE n = 1),
{built('tops', 'SELECT 0 AS g, g - 1 AS pos, h, count(*) OVER () AS n FROM subroots')},
{walked('inner_walk', 'nodes', "SELECT id, g, pos, '' AS proof, CASE WHEN changed THEN other ELSE leaf END AS f FROM p")},
{walked('outer_walk', 'tops', 'SELECT id, 0 AS g, g - 1 AS pos, proof, f FROM inner_walk_end')}
SELECT p.doc_id, p.leaf, s.h AS subroot, t.h AS root, sha256(o.proof) AS proof_sha256, o.f AS folded_root, o.f = t.h AS verified
FROM p JOIN subroots s USING (g) JOIN outer_walk_end o USING (id) CROSS JOIN (SELECT h FROM tops WHERE n = 1) t
"""


SQL = _sql()
