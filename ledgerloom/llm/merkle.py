"""Merkle manifest of a dataset, its proofs, and their verification, in DataFrame functions alone.

A leaf is the digest of a row's fields. Leaves of a group ascend by the order column; every run of `arity` consecutive nodes
becomes one node (the last run may be shorter, even a single node) until one is left, the group's subroot. Subroots, in
the order of their groups, form the top tree in the same way, which ends in the root.

Nodes are kept in aligned blocks of arity^height nodes. A block keeps each of its levels as one string of concatenated hex
digests: a fixed-width substring of a level is a run, its digest a parent, and the substrings that flank a node inside its
run are the sibling segments of its proof. The last level of a full block is a single node, so the roots of all blocks are
the nodes of the next tier, which is built by the same step; a tier has arity^height times fewer nodes than the one below.
Proofs come down the tiers: the path above a block is that of its root in the tier above.

Places of leaves are exact without ordering a group in one task: digests (never texts) are range-partitioned, written in
order, and a place is the rows of earlier files plus the row number in the file. A group that holds a third of all rows
therefore fills as many ranges, and no task or driver sees more than a range or a block. Only the number of tiers is read
by the driver.

Defined cases: a null field counts as `-`, apart from the empty text `0:`; a null group is a group, before all others;
null order values come first; equal order values are ordered by leaf, so repeated rows are equal leaves side by side; a
single leaf is its own subroot, and the subroot of a single group the root, each with an empty proof; an empty table
has no proofs and no root; columns that are not named are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.storage import located, saved

HEX = 64  # characters of a digest
HEIGHT = 6  # levels in a block: 64 leaves of a binary tree


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of the fields, each as UTF-8 byte count, `:` and value, or `-` if null."""
    texts = [f.cast("string") for f in fields]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


@dataclass(frozen=True)
class Manifest:
    """Block tables (grp, block, n, ids, levels) of the groups' trees and of the top tree, lowest tier first."""

    leaves: list[DataFrame]
    top: list[DataFrame]
    arity: int
    height: int

    def root(self) -> str | None:
        """Digest of the whole dataset, None if it is empty."""
        row = self.top[-1].select(F.element_at("levels", -1)).first()
        return row[0] if row else None


def _placed(nodes: DataFrame, keys: Sequence[str], *carried: str) -> DataFrame:
    """`place` (from 0) of each row of a group `grp` in the order of `keys`."""
    ties = F.rand(12).alias("_tie")  # equal rows may be parted, in any order
    ranged = nodes.select("grp", *keys, *carried, ties).repartitionByRange("grp", *[F.asc_nulls_first(k) for k in keys], "_tie")
    files = saved(ranged.sortWithinPartitions("grp", *[F.asc_nulls_first(k) for k in keys]).drop("_tie"), "merkle-order")
    rows = located(files, "grp", *keys, *carried)
    # file names begin with the number of the task that wrote them, tasks hold ascending ranges
    number = lambda pattern: F.regexp_extract("_path", pattern, 1).cast("int")
    counts = rows.groupBy("grp", "_path").agg(F.count("*").alias("_n"), F.min("_row").alias("_from"))
    counts = counts.withColumn("_order", F.struct(number(r"part-(\d+)-[^/]*$"), number(r"-c(\d+)\.[^/]*$")))
    before = F.expr("sum(_n) over (partition by grp order by _order rows between unbounded preceding and 1 preceding)")
    offset = (F.coalesce(before, F.lit(0)) - F.col("_from")).alias("_offset")
    offsets = counts.select(F.col("grp").alias("_g"), F.col("_path").alias("_p"), offset)
    joined = rows.join(offsets, (F.col("grp") == F.col("_g")) & (F.col("_path") == F.col("_p")))
    return joined.select("grp", (F.col("_row") + F.col("_offset")).alias("place"), *keys, *carried)


def _runs(level: Column, arity: int) -> Column:
    """Start (from 0) of every run of a level."""
    nodes = (F.length(level) / HEX).cast("int")
    return F.sequence(F.lit(0), nodes - 1, F.lit(arity))


def _parents(level: Column, arity: int) -> Column:
    run = lambda i: F.substring(level, i * HEX + 1, F.lit(arity * HEX))
    return F.array_join(F.transform(_runs(level, arity), lambda i: digest(run(i))), "")


def _blocks(nodes: DataFrame, arity: int, height: int, carried: Sequence[str] = ()) -> DataFrame:
    """Nodes (grp, place, node) gathered into blocks with all their levels. A block that is its whole group ends at one node."""
    size = arity**height
    row = F.struct("place", "node", *carried)
    held = nodes.groupBy("grp", F.floor(F.col("place") / size).alias("block")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    held = held.select(
        "grp",
        "block",
        F.size("rows").alias("n"),
        F.transform("rows", lambda r: F.struct(*[r[c].alias(c) for c in carried])).alias("ids") if carried else F.lit(None).cast("int").alias("ids"),
        F.array_join(F.col("rows")["node"], "").alias("level0"),
    )
    alone = F.col("groups_blocks") == 1
    sizes = held.groupBy(F.col("grp").alias("_g")).agg(F.count("*").alias("groups_blocks"))
    held = held.join(sizes, F.col("grp") == F.col("_g")).drop("_g")
    for k in range(height):
        below = F.col(f"level{k}")
        done = alone & (F.length(below) <= HEX)  # null levels follow the root of a lone block
        held = held.withColumn(f"level{k + 1}", F.when(~done, _parents(below, arity)))
    levels = F.array_compact(F.array(*[f"level{k}" for k in range(height + 1)]))
    return held.select("grp", "block", "n", "groups_blocks", "ids", levels.alias("levels"))


def _tree(nodes: DataFrame, arity: int, height: int, carried: Sequence[str] = ()) -> list[DataFrame]:
    """Written block tables of a forest, lowest first; the last has one block per group."""
    tiers = [saved(_blocks(nodes, arity, height, carried), "merkle-blocks")]
    while (tiers[-1].agg(F.max("groups_blocks")).first()[0] or 0) > 1:
        roots = tiers[-1].select("grp", F.col("block").alias("place"), F.element_at("levels", -1).alias("node"))
        tiers.append(saved(_blocks(roots, arity, height), "merkle-blocks"))
    return tiers


def build(leaves: DataFrame, order: str, carried: Sequence[str] = (), arity: int = 2, height: int = HEIGHT) -> Manifest:
    """Manifest of leaves (group text `grp`, order column, `leaf`, carried columns).

    Carried columns (the row's id, other digests of it) stay beside the leaf in its block.
    """
    if arity < 2 or height < 1:
        raise ValueError("arity from 2 and height from 1 on")
    key = F.coalesce(F.concat(F.lit("="), F.col("grp").cast("string")), F.lit("-"))  # "-" sorts before "="
    placed = _placed(leaves.withColumn("grp", key), [order, "leaf"], *[c for c in carried if c != order])
    trees = _tree(placed.withColumnRenamed("leaf", "node"), arity, height, carried)
    ends = trees[-1].select(F.lit("").alias("grp"), F.col("grp").alias("member"), F.element_at("levels", -1).alias("node"))
    top = _tree(_placed(ends, ["member", "node"]), arity, height, ["member"])
    return Manifest(trees, top, arity, height)


def _segments(levels: Column, place: Column, arity: int) -> Column:
    """Sibling segments (left, right) of a node of a block, level by level."""

    def segment(level: Column, k: Column) -> Column:
        at = F.floor(place / F.pow(F.lit(arity), k)).cast("int")
        start = at - at % arity
        left = F.substring(level, start * HEX + 1, (at - start) * HEX)
        right = F.substring(level, (at + 1) * HEX + 1, (start + arity - at - 1) * HEX)
        return F.struct(left.alias("left"), right.alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), segment)


def _paths(tiers: list[DataFrame], above: DataFrame, arity: int, height: int) -> DataFrame:
    """Path above each block of the lowest tier: (grp, block, path, and the columns of `above` but grp).

    `above` has one row per group with the path of its subroot.
    """
    kept = [c for c in above.columns if c not in ("grp", "path")]
    found = tiers[-1].select("grp", "block").join(above, "grp")
    for tier in reversed(tiers[1:]):
        inside = tier.join(found, ["grp", "block"])
        child = F.posexplode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda p: F.concat(_segments(F.col("levels"), p, arity), F.col("path"))))
        rows = inside.select("grp", *kept, F.col("block").alias("_b"), child.alias("_at", "path"))
        found = rows.select("grp", (F.col("_b") * arity**height + F.col("_at")).alias("block"), "path", *kept)
    return found


def fold(leaf: Column, path: Column) -> Column:
    """Root that a leaf and its sibling segments lead to."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(s["left"], node, s["right"])))


def proofs(manifest: Manifest, carried: Sequence[str]) -> DataFrame:
    """One row per leaf: the carried columns, leaf, subroot, root and path (sibling segments from the leaf to the root)."""
    arity, height = manifest.arity, manifest.height
    roots = manifest.top[-1].select("grp", F.element_at("levels", -1).alias("root"), F.expr("cast(array() as array<struct<left:string,right:string>>)").alias("path"))
    tops = manifest.top[0].join(_paths(manifest.top, roots, arity, height), ["grp", "block"])
    member = F.transform(
        "ids", lambda m, p: F.struct(
            m["member"].alias("grp"),
            F.substring(F.col("levels")[0], p * HEX + 1, F.lit(HEX)).alias("subroot"),
            F.concat(_segments(F.col("levels"), p, arity), F.col("path")).alias("path"),
        )
    )
    groups = tops.select("root", F.inline(member))
    blocks = manifest.leaves[0].join(_paths(manifest.leaves, groups, arity, height), ["grp", "block"])
    leaf = F.transform(
        "ids", lambda m, p: F.struct(
            *[m[c].alias(c) for c in carried],
            F.substring(F.col("levels")[0], p * HEX + 1, F.lit(HEX)).alias("leaf"),
            F.concat(_segments(F.col("levels"), p, arity), F.col("path")).alias("path"),
        )
    )
    return blocks.select("subroot", "root", F.inline(leaf)).select(*carried, "leaf", "subroot", "root", "path")


def proof_digest(path: Column) -> Column:
    """Digest of all sibling digests, from leaf to root and left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def audit(
    docs: DataFrame,
    fields: Sequence[str],
    group: str,
    order: str,
    received: Mapping[str, Column] | None = None,
    changed: Column | None = None,
    arity: int = 2,
    height: int = HEIGHT,
) -> DataFrame:
    """Proofs of a table and whether its rows, as received, lead to the root.

    `received` replaces fields where `changed` holds (it stands for a copy of the table that may have been altered); other
    rows are received as they are. Columns: order column, leaf, subroot, root, path, folded_root, verified.
    """
    col = {f: F.col(f"`{f}`") for f in fields}
    leaf = leaf_digest([col[f] for f in fields])
    altered = leaf_digest([(received or {}).get(f, col[f]) for f in fields])
    got = F.when(changed, altered) if changed is not None else F.lit(None).cast("string")
    rows = docs.select(F.col(f"`{group}`").alias("grp"), F.col(f"`{order}`").alias("id"), leaf.alias("leaf"), got.alias("received"))
    found = proofs(build(rows, "id", ["id", "received"], arity, height), ["id", "received"])
    found = found.withColumn("folded_root", fold(F.coalesce("received", "leaf"), F.col("path")))
    return found.withColumn("verified", F.col("folded_root") == F.col("root")).drop("received")
