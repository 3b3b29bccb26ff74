"""Placing documents by a hierarchical weighted hash tree: region, rack, shard.

At every level each child draws an exponential variate from a hash of the key and of its own name,
divided by its weight; the smallest draw wins. A child is therefore chosen in proportion to its
weight, its draw depends on nothing but the key, its name and its weight, and a changed weight moves
rows only into or out of that child. A shard added as a region of its own takes rows only into
itself. Only built-in functions are used.

Defined cases: a missing text has size 8 and checksum 0; a missing id is placed by the empty key;
repeated rows share a shard and get slots of their own; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import stored, whole_text

DRAW_DIGITS = 13  # hexadecimal digits of a draw: 52 bits, exact in a double
SLOT_BUCKETS = 1024


@dataclass(frozen=True)
class Leaf:
    """One shard and its place in the tree."""

    region: str
    rack: str
    shard: int
    weight: float = 1.0


def even_tree(regions: int = 2, racks: int = 3, shards: int = 4) -> list[Leaf]:
    return [
        Leaf(f"r{r}", f"r{r}k{k}", (r * racks + k) * shards + s)
        for r in range(regions)
        for k in range(racks)
        for s in range(shards)
    ]


def with_new_region(tree: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in a region of its own."""
    number = max(leaf.shard for leaf in tree) + 1
    return [*tree, Leaf(f"n{number}", f"n{number}k0", number, weight)]


def _draw(key: Column, child: Column) -> Column:
    """An exponential variate of the key and the child's name, divided by the child's weight."""
    digest = F.substring(F.md5(F.concat(key, F.lit("/"), child["name"])), 1, DRAW_DIGITS)
    uniform = (F.conv(digest, 16, 10).cast("double") + 0.5) / float(16**DRAW_DIGITS)
    return -F.log(uniform) / child["weight"]


def _level(nodes: dict[str, list[tuple[str, float]]]) -> Column:
    """A map from each node to its children with their weights."""
    return F.create_map(*(
        x
        for parent, children in nodes.items()
        for x in (
            F.lit(parent),
            F.array(*(F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in children)),
        )
    ))


def _descend(key: Column, node: Column, level: Column) -> Column:
    """The child with the smallest draw; equal draws go to the first name in order."""
    draws = F.transform(
        F.element_at(level, node), lambda c: F.struct(_draw(key, c).alias("draw"), c["name"].alias("name")))
    return F.array_min(draws)["name"]


def place(key: Column, tree: Sequence[Leaf]) -> Column:
    """The shard of a key: one weighted draw per level. Shards without weight get nothing."""
    regions: dict[str, dict[str, list[Leaf]]] = {}
    for leaf in tree:
        if leaf.weight > 0:
            regions.setdefault(f"region-{leaf.region}", {}).setdefault(f"rack-{leaf.rack}", []).append(leaf)
    if not regions:
        raise ValueError("no shard has a weight")
    total = lambda leaves: sum(x.weight for x in leaves)
    root = {"root": [(r, sum(map(total, racks.values()))) for r, racks in regions.items()]}
    racks = {r: [(k, total(leaves)) for k, leaves in racks.items()] for r, racks in regions.items()}
    shards = {
        k: [(f"shard-{x.shard}", x.weight) for x in leaves] for racks in regions.values() for k, leaves in racks.items()}
    node = F.lit("root")
    for level in (root, racks, shards):
        node = _descend(key, node, _level(level))
    return F.substring_index(node, "-", -1).cast("int")


def shard_documents(
    docs: DataFrame,
    tree: Sequence[Leaf] | None = None,
    grown: Sequence[Leaf] | None = None,
    buckets: int = SLOT_BUCKETS,
) -> DataFrame:
    """One row per document: its shard, its gapless slot in it, and its shard in the grown tree.

    Slots are numbered without gathering a shard: rows are numbered inside hash buckets of a shard,
    and the sizes of a shard's earlier buckets are added.
    """
    tree = even_tree() if tree is None else tree
    grown = with_new_region(tree) if grown is None else grown
    text, key = whole_text("text"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    bucket = F.conv(F.substring(F.md5(key), 1, 6), 16, 10).cast("int") % buckets
    rows = stored(
        docs.select(
            "doc_id",
            (F.octet_length(text).cast("long") + 8).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.lit("key").alias("law"),
            place(key, tree).alias("shard"),
            place(key, grown).alias("grown_shard"),
            bucket.alias("bucket"),
        ),
        "shards",
    )
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    inside = W.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("place", F.row_number().over(inside))
        .join(offsets, ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", "law", "shard",
                (F.col("offset") + F.col("place") - 1).alias("slot"), "grown_shard")
    )
