"""Merkle dataset manifest by nested-struct rollup.

A row's leaf is the SHA-256 of its columns; the leaves of a group, in key
order, form a tree of runs of ``fanout`` nodes, and the groups' roots, in group
order, another one.

A leaf's rank in its group is written as digits to the base ``fanout``; the low
``depth`` digits are its place in a block, the rest is the block.  All of a
block meets in one task once (one exchange by group and block), and there the
digit columns are grouped away one after the other, from the lowest: the nodes
that agree in all other digits become the ``kids`` of a struct with their hash.
What is left is one row per block, a struct nested ``depth`` deep over at most
``fanout ** depth`` leaves.  The blocks' hashes are the leaves of the next tier,
rolled up in the same way until every group has one block.

Proofs go down the same structs: ``transform`` walks a block's kids with the
path from above, and ``inline`` turns them into rows, so no sibling is ever
looked up or joined.  Between tiers a block's struct and its path from above
meet by an aggregate over (group, block), each of which has one of either; no
row holds more than a block, whatever a group's share of all rows.

Defined results: a null column counts as ``-``; a null group is a group of its
own and the first, null keys are first in their group, rows that repeat a key
are leaves of their own in order of their hashes, and rows equal in all columns
may change places; texts are hashed whole; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlake.llm.common import stored
from credlake.llm.sharding import with_slots

FANOUT, DEPTH = 2, 10
STEP = "array<struct<left: string, right: string>>"


def digest(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def field(value: Column) -> Column:
    """The value's UTF-8 byte count, a colon and the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["left"], h, s["right"]))


def proof_digest(path: Column) -> Column:
    """SHA-256 of a path's siblings, from the leaf up, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def _nest(rows: DataFrame, payload: list[str], fanout: int, depth: int) -> DataFrame:
    """(group, block, node) of (group, rank, hash, payload): a block's nodes as one nested struct."""
    digits = [f"d{i}" for i in range(depth)]
    out = rows.select("group", F.expr(f"rank div {fanout ** depth}").alias("block"),
                      *[F.expr(f"cast(rank div {fanout ** i} % {fanout} as int)").alias(d) for i, d in enumerate(digits)],
                      F.struct(F.expr(f"cast(rank % {fanout} as int)").alias("digit"), "hash", *payload).alias("node")).repartition("group", "block")
    for i in range(depth):
        higher = digits[i + 1:]
        out = out.groupBy("group", "block", *higher).agg(F.sort_array(F.collect_list("node")).alias("kids"))
        # Ranks have no gaps: a first node without a second one is the group's only node of its level, and stays as it is.
        first = F.col("block") == 0
        for d in higher:
            first &= F.col(d) == 0
        alone = first & (F.size("kids") == 1)
        node = F.when(alone, F.col("kids")[0]["hash"]).otherwise(digest(F.array_join("kids.hash", "")))
        out = out.select("group", "block", *higher, F.struct((F.col(higher[0]) if higher else F.lit(0)).alias("digit"), node.alias("hash"),
                                                             alone.alias("alone"), "kids").alias("node"))
    return out


def _walk(node: Column, path: Column, payload: list[str], depth: int) -> Column:
    """The leaves below a node as structs of hash, payload and path."""
    def kids(at: Column) -> Column:
        hashes = at["node"]["kids"]["hash"]

        def kid(node: Column, i: Column) -> Column:
            step = F.struct(F.array_join(F.slice(hashes, F.lit(1), i), "").alias("left"),
                            F.array_join(F.slice(hashes, i + 2, F.size(hashes)), "").alias("right"))
            own = F.when(at["node"]["alone"], F.array().cast(STEP)).otherwise(F.array(step))
            return F.struct(node.alias("node"), F.concat(own, at["path"]).alias("path"))
        return F.transform(at["node"]["kids"], kid)
    # Level by level, so that a node's path is made once for all below it.
    level = F.array(F.struct(node.alias("node"), path.alias("path")))
    for _ in range(depth):
        level = F.flatten(F.transform(level, kids))
    return F.transform(level, lambda at: F.struct(at["node"]["hash"].alias("hash"), *[at["node"][c].alias(c) for c in payload], at["path"].alias("path")))


def _tiers(leaves: DataFrame, payload: list[str], fanout: int, depth: int) -> list[DataFrame]:
    """The nested blocks of the leaves (group, rank, hash, payload), of their blocks' hashes, and so on."""
    tiers = [stored(_nest(leaves, payload, fanout, depth), "merkle")]
    while not tiers[-1].where("block > 0").isEmpty():
        tops = tiers[-1].select("group", F.col("block").alias("rank"), F.col("node.hash").alias("hash"))
        tiers.append(stored(_nest(tops.withColumn("child", F.col("rank")), ["child"], fanout, depth), "merkle"))
    return tiers


def _meet(blocks: DataFrame, above: DataFrame, facts: list[str]) -> DataFrame:
    """Every block (group, block, node) with the one row of ``above`` (group, block, facts) about it."""
    rows = blocks.select("group", "block", "node").unionByName(above.select("group", "block", F.struct(*facts).alias("above")), allowMissingColumns=True)
    met = rows.groupBy("group", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("node", "above")])
    return met.select("group", "block", "node", *[F.col("above")[c].alias(c) for c in facts])


def _proofs(tiers: list[DataFrame], payload: list[str], carried: list[str], above: DataFrame | None, depth: int) -> DataFrame:
    """(group, hash, payload, path, carried) for every leaf; ``above`` has (group, block, path, carried) for the last tier's blocks."""
    for i, tier in reversed(list(enumerate(tiers))):
        names = payload if i == 0 else ["child"]
        if above is None:  # the whole forest's own root
            rows = tier.select("*", F.array().cast(STEP).alias("path"), F.col("node.hash").alias("root"))
        else:
            rows = _meet(tier, above, ["path", *carried])
        out = rows.select("group", *carried, F.inline(_walk(F.col("node"), F.col("path"), names, depth)))
        above = out.withColumnRenamed("child", "block") if i else out
    return above


def manifest(df: DataFrame, key: str, group: str, columns: list[str], carry: dict[str, Column] | None = None,
             fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """(key, leaf, path, subroot, root) for every row, with ``carry``'s columns of the row.

    ``columns`` are hashed in their order; ``path`` lists, from the leaf up, the
    siblings' hashes left and right of the way, the group's tree before the one
    over the groups.  ``fold(leaf, path)`` is ``root``.
    """
    extra = carry or {}
    named = {f"c{i}": c for i, c in enumerate(extra.values())}
    payload = ["id", *named]
    # Spark orders texts bytewise; "-" is before "=", so null is first.  Equal rows are dealt apart by the salt.
    leaves = df.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-")).alias("group"), F.col(key).alias("id"),
                       leaf_of(*[F.col(c) for c in columns]).alias("hash"), *[c.alias(n) for n, c in named.items()], F.rand(7).alias("salt"))
    ranked = with_slots(leaves, "group", ["id", "hash", "salt"], "rank")
    trees = _tiers(ranked, payload, fanout, depth)
    subroots = trees[-1].select(F.lit("").alias("all"), F.col("group").alias("name"), F.col("node.hash").alias("hash"))
    over = with_slots(subroots, "all", ["name"], "rank").withColumnRenamed("all", "group")
    roots = _proofs(_tiers(over, ["name"], fanout, depth), ["name"], ["root"], None, depth)
    above = roots.select(F.col("name").alias("group"), F.lit(0).cast("long").alias("block"), "path", F.col("hash").alias("subroot"), "root")
    out = _proofs(trees, payload, ["subroot", "root"], above, depth)
    return out.select(F.col("id").alias(key), F.col("hash").alias("leaf"), "path", "subroot", "root",
                      *[F.col(n).alias(c) for n, c in zip(named, extra)])
