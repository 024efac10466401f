"""A Merkle manifest of a table: one leaf per row, a tree per group, a tree over the groups, and a proof per row.

A leaf is the hash of its row's fields, each `-` if null, else its UTF-8 byte count, `:` and the value. In a group
the leaves ascend by the order column; every ``FAN`` consecutive nodes become the hash of their digests (as hex
text), the last run with what is left, until one node remains: the subroot. Subroots, by group (null first,
bytewise), likewise give the root. A proof lists, level by level up to the root, the digests to the left and to the
right of the path.

Ranks come from one range exchange: each partition is sorted, a row's place in it is counted as it is written, and
the counts of the partitions give each its offset. A group that holds a third of all rows is spread like any other.

The tree is a nested-struct rollup. A rank's digits to the base FAN are columns; a block is FAN ** DIGITS
consecutive nodes. Within a block the digit columns are grouped away one after the other, each time hashing the
children and nesting their structs in the parent's, all in the partitioning of the block. Block roots are the
nodes of the next round, so no row ever holds more than a block. On the way back each block meets the proof of its
root by a union and one grouping, and a transform per digit unfolds the nested structs into the proofs of the
children; an explode emits the rows. No proof is joined.

Rows of equal order value ascend by leaf; equal leaves are interchangeable. Null fields, also a null group or order
value (first), are as above. Repeated rows are leaves of their own. An empty table has no rows and no root. Columns
beyond the fields, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotebook.llm.staging import keep

FAN = 3
#: Digits per block: a block has FAN ** DIGITS nodes at most.
DIGITS = 6
BLOCK = FAN**DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "struct<l:string,r:string>"


def leaf_hash(*values: Column) -> Column:
    """Lower-case hex sha256 of the encoded fields."""
    texts = [v.cast("string") for v in values]
    coded = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*coded), 256)


# --- ranks ---------------------------------------------------------------------------------------


def _ranked(rows: DataFrame, label: str, group: list[str], *order: str) -> DataFrame:
    """Add ``rank`` (from 0) within the group columns and ``n``, the group's size."""
    place = F.monotonically_increasing_id()
    ordered = rows.repartitionByRange(*[F.asc_nulls_first(c) for c in (*group, *order)]).sortWithinPartitions(
        *[F.asc_nulls_first(c) for c in (*group, *order)]
    )
    placed = keep(
        ordered.withColumn("at", place).select(
            "*", F.shiftright("at", 33).cast("int").alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("pos")
        ).drop("at"),
        label,
    )
    # One row per partition and group: the group's rows there are consecutive.
    runs = placed.groupBy("part", *group).agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    runs = runs.select(
        F.col("part").alias("run_part"), *[F.col(g).alias(f"run_{g}") for g in group],
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("n"),
    )
    same = F.col("part") == F.col("run_part")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"run_{g}"))
    joined = placed.join(runs, same)
    return joined.withColumn("rank", F.col("pos") + F.col("shift")).drop(
        "part", "pos", "shift", "run_part", *[f"run_{g}" for g in group]
    )


# --- up: fold a block's digits ---------------------------------------------------------------------


def _fold(nodes: DataFrame, group: list[str], payload: list[str]) -> DataFrame:
    """One row per block: group, block, n, h and the nested ``kids``, from nodes (group, rank, n, h, payload).

    A level whose only node is left of the whole group is passed through (``pass``): nothing is hashed there.
    """
    digits = [f"d{i}" for i in range(DIGITS)]
    level = nodes.select(
        *group, "n", F.expr(f"rank div {BLOCK}").alias("block"),
        *[F.expr(f"cast(rank div {FAN**i} % {FAN} AS tinyint)").alias(d) for i, d in enumerate(digits)],
        F.struct("h", *payload).alias("node"),
    ).repartition(*group, "block")
    for i, d in enumerate(digits):
        keys = [*group, "n", "block", *digits[i + 1 :]]
        kids = F.transform(F.sort_array(F.collect_list(F.struct(d, "node"))), lambda k: k.node)
        level = level.groupBy(*keys).agg(kids.alias("kids"))
        # Nodes of the group below this level: n / FAN ** i, rounded up.
        alone = F.expr(f"n <= {FAN**i}")
        folded = F.sha2(F.array_join(F.transform("kids", lambda k: k.h), ""), 256)
        h = F.when(alone, F.expr("kids[0].h")).otherwise(folded)
        level = level.select(*keys, F.struct(h.alias("h"), alone.alias("pass"), "kids").alias("node"))
    return level.select(*group, "n", "block", "node")


# --- down: unfold proofs --------------------------------------------------------------------------


def _unfold(blocks: DataFrame, above: DataFrame, group: list[str], carried: list[str], payload: list[str]) -> DataFrame:
    """(group, rank of the child, its payload, path, carried) of every node, from the proofs of the blocks.

    ``above`` has (group, block, path, carried): the path from the block's root up.
    """
    none = [F.lit(None).cast(above.schema[c].dataType).alias(c) for c in ("path", *carried)]
    node_type = blocks.schema["node"].dataType
    both = blocks.select(*group, "block", "node", *none).unionByName(
        above.select(*group, "block", F.lit(None).cast(node_type).alias("node"), "path", *carried)
    )
    met = both.groupBy(*group, "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("node", "path", *carried)])
    rows = met.filter("node IS NOT NULL").select(*group, "block", *carried, F.expr("array(struct(node AS node, path AS path))").alias("found"))
    left = "array_join(transform(slice(x.node.kids, 1, i), k -> k.h), '')"
    right = f"array_join(transform(slice(x.node.kids, i + 2, {FAN}), k -> k.h), '')"
    step = f"if(x.node.pass, x.path, concat(array(cast(named_struct('l', {left}, 'r', {right}) AS {_STEP})), x.path))"
    for _ in range(DIGITS):
        rows = rows.withColumn(
            "found", F.expr(f"flatten(transform(found, x -> transform(x.node.kids, (k, i) -> struct(k AS node, {step} AS path))))")
        )
    # Only the last run of a group is short, so a node's place in its block is its place in the list.
    return rows.select(*group, "block", *carried, F.posexplode("found").alias("at", "x")).select(
        *group, (F.col("block") * BLOCK + F.col("at")).alias("block"), "x.path", *carried,
        *[F.col(f"x.node.{p}").alias(p) for p in payload],
    )


def _climb(nodes: DataFrame, label: str, group: list[str], payload: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of blocks from the leaves up, and the last round's single node per group (group, h)."""
    rounds: list[DataFrame] = []
    while True:
        blocks = keep(_fold(nodes, group, payload if not rounds else []), f"{label}-{len(rounds)}")
        rounds.append(blocks)
        most = blocks.agg(F.max("n")).first()[0] or 0
        if most <= BLOCK:
            return rounds, blocks.select(*group, F.col("node.h").alias("h"))
        nodes = blocks.select(
            *group, F.col("block").alias("rank"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("node.h").alias("h")
        )


def _descend(rounds: list[DataFrame], tops: DataFrame, group: list[str], carried: list[str], payload: list[str]) -> DataFrame:
    """Proofs of all leaves from the path above each group's top (group, path, carried)."""
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for i, blocks in reversed(list(enumerate(rounds))):
        above = _unfold(blocks, above, group, carried, payload if i == 0 else [])
    return above


# --- the manifest ---------------------------------------------------------------------------------


def manifest(
    rows: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    group_col: str = "source",
    order_col: str = "doc_id",
    presented: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row: ``id`` (order value), leaf, shown, subroot, root, proof (array<struct<l, r>>).

    ``presented`` replaces fields by what a reader claims they hold; ``shown`` is the hash of that row, to be checked
    against the root by ``folded``.
    """
    claimed = presented or {}
    leaves = rows.select(
        F.col(order_col).alias("id"),
        F.col(group_col).cast("string").alias("g"),
        leaf_hash(*[F.col(f) for f in fields]).alias("h"),
        leaf_hash(*[claimed.get(f, F.col(f)) for f in fields]).alias("shown"),
    )
    ranked = _ranked(leaves, "merkle-leaves", ["g"], "id", "h")
    lower, subroots = _climb(ranked, "merkle-groups", ["g"], ["id", "shown"])
    tops = subroots.select(F.lit(0).alias("t"), "g", "h")
    upper, roots = _climb(_ranked(tops, "merkle-subroots", ["t"], "g"), "merkle-root", ["t"], ["g"])
    start = roots.select("t", F.expr(f"cast(array() AS array<{_STEP}>)").alias("path"), F.col("h").alias("root"))
    # The leaf of the upper tree carries its own digest down as the subroot of its group.
    above = _descend(upper, start, ["t"], ["root"], ["g", "h"])
    groups = above.select("g", "path", F.col("h").alias("subroot"), "root")
    proofs = _descend(lower, groups, ["g"], ["subroot", "root"], ["id", "h", "shown"])
    return proofs.select("id", F.col("g").alias("group"), F.col("h").alias("leaf"), "shown", "subroot", "root", F.col("path").alias("proof"))


def folded(leaf: str = "shown", proof: str = "proof") -> Column:
    """The root that a leaf's digest and its proof lead to."""
    return F.expr(f"aggregate({proof}, {leaf}, (h, p) -> sha2(concat(p.l, h, p.r), 256))")


def proof_hash(proof: str = "proof") -> Column:
    """The hash of all siblings, level by level up, from left to right."""
    return F.expr(f"sha2(array_join(transform({proof}, p -> concat(p.l, p.r)), ''), 256)")
