"""Merkle manifest of a table: a digest per row, a tree per group, and a tree over the groups.

A tree is built block by block. A block holds an aligned run of ``2 ** BLOCK_LEVELS`` nodes of one
level as one hex string; the parents are the digests of its 128-character substrings, again one
string. The sibling of a node at any level is the 64 characters beside it, so a node's segment of
the proof is cut from the strings of its block. Block roots are the nodes of the next tier of
blocks, until a group has one block; the roots of the groups are one more group.

A block is a bounded row, however many rows its group has. Leaves are shuffled once to sort them and
once into blocks, as digests without their texts; above that there is one row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import stored
from pulsegrid.operators.partitions import row_index, running_total

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_LEVELS = 8
WIDE = 1 << BLOCK_LEVELS
HEX = 64


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, joined."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(values: list[Column]) -> Column:
    """Digest of a row: each value as ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    texts = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _node(level: Column, place: Column) -> Column:
    """The digest at a place of a level string; empty beyond its end."""
    return F.substring(level, (place * HEX + 1).cast("int"), F.lit(HEX))


def _parents(level: Column) -> Column:
    """The next level: digests of two nodes each, the last of one if their number is odd."""
    pairs = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / (2 * HEX)).cast("int"))
    made = F.transform(pairs, lambda i: F.sha2(F.substring(level, i * (2 * HEX) + 1, F.lit(2 * HEX)), 256))
    return F.array_join(made, "")


def _blocks(nodes: DataFrame, keep: list[str]) -> DataFrame:
    """One row per block of ``nodes`` (grp, n, pos, hash): its ``levels`` from the nodes to its root, and the kept columns of its nodes."""
    block = F.shiftright("pos", BLOCK_LEVELS)
    slot = F.col("pos").bitwiseAND(WIDE - 1).cast("int").alias("slot")
    rows = nodes.groupBy("grp", "n", block.alias("block")).agg(F.array_sort(F.collect_list(F.struct(slot, "hash", *keep))).alias("nodes"))
    nodes_level = F.array_join(F.transform("nodes", lambda x: x["hash"]), "")
    # a group of one block stops at its single root; a wider one is halved as often in all its blocks
    height = F.when(F.col("n") > WIDE, BLOCK_LEVELS).otherwise(F.ceil(F.log2(F.col("n").cast("double"))).cast("int"))
    rounds = F.slice(F.array(*[F.lit(i) for i in range(BLOCK_LEVELS)]), F.lit(1), height)
    levels = F.aggregate(rounds, F.array(nodes_level), lambda made, _: F.concat(made, F.array(_parents(F.element_at(made, -1)))))
    kept = F.transform("nodes", lambda x: F.struct(x["slot"].alias("slot"), *[x[c].alias(c) for c in keep]))
    return rows.select("grp", "n", "block", kept.alias("nodes"), levels.alias("levels"))


def _climb(nodes: DataFrame, keep: list[str], most: int) -> list[DataFrame]:
    """Tiers of blocks, until the largest group (of ``most`` nodes) has one block."""
    tiers = [stored(_blocks(nodes, keep), "tier")]
    while most > WIDE:
        most = -(-most // WIDE)
        wide = tiers[-1].where(F.col("n") > WIDE)
        up = wide.select("grp", F.ceil(F.col("n") / WIDE).alias("n"), F.col("block").alias("pos"), F.element_at("levels", -1).alias("hash"))
        tiers.append(stored(_blocks(up, []), "tier"))
    return tiers


def _group_roots(tiers: list[DataFrame]) -> DataFrame:
    """``grp`` and ``hash``, the root of each group: of its only block in the tier where it has one."""
    roots = [t.where(F.col("n") <= WIDE).select("grp", F.element_at("levels", -1).alias("hash")) for t in tiers]
    out = roots[0]
    for more in roots[1:]:
        out = out.unionByName(more)
    return out


def _descend(tiers: list[DataFrame], tops: DataFrame, passed: list[str]) -> DataFrame:
    """Proofs of all nodes of the lowest tier.

    ``tops`` has for each ``grp`` the ``proof`` and ``sides`` above its root and the ``passed`` columns.
    """
    higher = None
    for tier in reversed(tiers):
        last = tier.where(F.col("n") <= WIDE).select("grp", "block").join(tops, "grp")
        above = last if higher is None else last.unionByName(higher.select("grp", F.col("pos").alias("block"), "proof", "sides", *passed))
        higher = _proofs(tier.join(above, ["grp", "block"]), passed)
    return higher


def _proofs(blocks: DataFrame, passed: list[str]) -> DataFrame:
    """A row per node of each block: its ``hash`` and, from its block upwards, the siblings and the ``sides`` they stand on."""
    at = blocks.select("grp", "block", "levels", "proof", "sides", *passed, F.explode("nodes").alias("node"))
    slot, levels = F.col("node.slot"), F.col("levels")
    below = F.slice(levels, F.lit(1), F.size(levels) - 1)
    place = lambda height: F.call_function("shiftright", slot, height)
    beside = lambda height: place(height).bitwiseXOR(F.lit(1))
    siblings = F.transform(below, lambda level, height: _node(level, beside(height)))
    left = lambda height: F.when(place(height).bitwiseAND(F.lit(1)) == 1, "l").otherwise("r")
    sides = F.transform(below, lambda level, height: F.when(beside(height) * HEX >= F.length(level), "-").otherwise(left(height)))
    return at.select(
        "grp",
        (F.col("block") * WIDE + slot).alias("pos"),
        _node(F.element_at(levels, 1), slot).alias("hash"),
        F.concat(F.array_join(siblings, ""), F.col("proof")).alias("proof"),
        F.concat(F.array_join(sides, ""), F.col("sides")).alias("sides"),
        *passed,
        F.col("node"),
    )


def fold(leaf: Column, proof: Column, sides: Column) -> Column:
    """Root that a leaf gives with a proof: at each level the sibling left (``l``), right (``r``) or none (``-``)."""

    def step(s: Column, side: Column) -> Column:
        sibling = F.substring(proof, s["at"], F.lit(HEX))
        made = F.when(side == "l", digest(sibling, s["node"])).when(side == "r", digest(s["node"], sibling)).otherwise(F.sha2(s["node"], 256))
        return F.struct(F.when(side == "", s["node"]).otherwise(made).alias("node"), F.when(side == "-", s["at"]).otherwise(s["at"] + HEX).alias("at"))

    return F.aggregate(F.split(sides, ""), F.struct(leaf.alias("node"), F.lit(1).alias("at")), step, lambda s: s["node"])


def build_manifest(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", columns: tuple[str, ...] = COLUMNS,
    seen: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof`` (siblings from the leaf up, 64 hex characters each) and ``sides``.

    The leaf covers the named columns, which are integers or strings. Leaves of a group ascend by id
    (null last, equal ids by leaf); groups ascend bytewise, null first. Each row is a leaf, repeated
    rows too; null and empty values differ. ``seen``, the leaf of a row as someone else holds it, is
    carried along as ``seen`` to be folded. An empty table gives no rows; other columns are not read.
    """
    leaf = leaf_digest([F.col(f"`{c}`") for c in columns])
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{group_col}`").alias("grp_key"), leaf.alias("hash"),
        (F.lit(None).cast("string") if seen is None else seen).alias("seen"), F.monotonically_increasing_id().alias("uid"),
    )
    leaves = stored(rows, "leaves")
    groups = row_index(leaves.groupBy("grp_key").agg(F.count("*").alias("n")), ["grp_key"], "grp")
    groups = stored(running_total(groups, ["grp"], "n", "upto"), "groups")
    n_groups, most = groups.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    placed = leaves.join(groups, leaves["grp_key"].eqNullSafe(groups["grp_key"])).select(
        "grp", "n", (F.col("upto") - F.col("n")).alias("first"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash", "seen", "uid"
    )
    placed = row_index(placed, ["grp", "no_id", "doc_id", "hash", "uid"], "pos").withColumn("pos", F.col("pos") - F.col("first"))
    tiers = _climb(placed, ["doc_id", "seen"], most)
    roots = _group_roots(tiers).select(F.lit(0).cast("long").alias("grp"), F.lit(n_groups).cast("long").alias("n"), F.col("grp").alias("pos"), "hash")
    top = _climb(roots, [], n_groups)
    root = _group_roots(top).select("grp", F.col("hash").alias("root"), F.lit("").alias("proof"), F.lit("").alias("sides"))
    tops = _descend(top, root, ["root"]).select(F.col("pos").alias("grp"), F.col("hash").alias("subroot"), "root", "proof", "sides")
    proofs = _descend(tiers, stored(tops, "tops"), ["subroot", "root"])
    return proofs.select("node.doc_id", F.col("hash").alias("leaf"), "subroot", "root", "proof", "sides", "node.seen")
