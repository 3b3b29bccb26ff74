"""Near-duplicates by SimHash, found through a segment-popcount embedding.

A fingerprint is cut into 32 segments of two bits; the embedding holds the bit count of each. The
Manhattan distance of two embeddings is never more than the Hamming distance of the fingerprints,
since one differing bit changes one count by one. A range join under that distance therefore loses
no link. It is a grid join: the counts form 7 blocks, and two embeddings within distance 3 agree
on at least 4 of them, so each fingerprint is put into the cell of every choice of 4 blocks. In a
cell the Manhattan bound is applied first and the Hamming distance decides.

Equal fingerprints are one node. A cell gives a spanning forest of its links, not all pairs; a
cell with many fingerprints is cut into parts, and every two parts are compared in a task of
their own. Components are found by rounds of star operations on the links.

Defined cases: a missing or empty text has fingerprint zero; a missing doc_id never becomes a
component id (a component of such rows only has none); repeated rows share a component; other
columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.functions.joins import lookup_join
from tidemark.llm.common import stored

SHINGLE = 3
SEED = 42
MAX_BITS = 3
BLOCKS = 7
EQUAL_BLOCKS = BLOCKS - MAX_BITS
PART = 4096  # fingerprints of a cell compared in one task at once
EVEN_BITS = 0x5555555555555555


# --- fingerprints -------------------------------------------------------------------------------


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: lower-cases A-Z only
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    last = ends[-n:].tolist()
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last)), np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """Each bit is the majority of that bit in all hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[i : i + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(shingle_hashes(x.as_py())) for x in batch.column("text")]
        values = pa.array(np.array(prints, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], ["doc_id", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print): the fingerprint as a signed 64-bit integer."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_fingerprint_batches, f"doc_id {kind}, print bigint")


# --- links --------------------------------------------------------------------------------------


def bit_counts(prints: np.ndarray) -> np.ndarray:
    """The embedding, its 32 counts still packed, two bits each."""
    even = np.uint64(EVEN_BITS)
    return (prints & even) + ((prints >> np.uint64(1)) & even)


def cell_masks() -> list[int]:
    """For each choice of blocks, the bits of their segments' counts."""
    segments = np.array_split(np.arange(32), BLOCKS)
    blocks = [sum(3 << (2 * int(s)) for s in part) for part in segments]
    return [sum(c) for c in combinations(blocks, EQUAL_BLOCKS)]


MASKS = np.array(cell_masks(), np.uint64)


def _cell_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
        counts = bit_counts(prints)
        for number, mask in enumerate(MASKS):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(prints), number, np.int16)),
                    pa.array((counts & mask).view(np.int64)),
                    pa.array(prints.view(np.int64)),
                ],
                ["choice", "cell", "print"],
            )


def manhattan(counts: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Sum of the absolute differences of packed counts (0 to 2 each), as two unary bits each."""
    unary = lambda c: ((c | (c >> np.uint64(1))) & np.uint64(EVEN_BITS)) | (c & ~np.uint64(EVEN_BITS))
    return np.bitwise_count(unary(counts) ^ unary(other))


def close_pairs(left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs within MAX_BITS, one row of ``left`` at a time against all of ``right``."""
    counts, found_l, found_r = bit_counts(right), [], []
    own = counts if same else bit_counts(left)
    for i in range(len(left)):
        begin = i + 1 if same else 0
        near = np.flatnonzero(manhattan(counts[begin:], own[i]) <= MAX_BITS) + begin
        near = near[np.bitwise_count(right[near] ^ left[i]) <= MAX_BITS]
        if len(near):
            found_l.append(np.full(len(near), i))
            found_r.append(near)
    empty = np.empty(0, np.int64)
    return (np.concatenate(found_l), np.concatenate(found_r)) if found_l else (empty, empty)


def forest(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each node to the smallest of its component, for the given links between indices."""
    label = np.arange(len(nodes))
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (before == label).all():
            break
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _links(left: np.ndarray, right: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    if right is None:
        return forest(left, *close_pairs(left, left, same=True))
    a, b = close_pairs(left, right, same=False)
    return forest(np.concatenate((left, right)), a, b + len(left))


LINK_FIELDS = ["choice", "cell", "part", "a", "b"]


def _link_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    none = [pa.nulls(len(a), t) for t in (pa.int16(), pa.int64(), pa.int32())]
    return pa.RecordBatch.from_arrays([*none, pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], LINK_FIELDS)


def _cells_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by cell: the links of each cell, or the parts of one that is too large.

    A row with ``part`` set passes a fingerprint on; a row without it is a link. Never more than
    PART fingerprints are held.
    """
    key, held, size, part = None, [], 0, 0

    def handed_on() -> pa.RecordBatch:
        columns = [np.full(size, key[0], np.int16), np.full(size, key[1]), np.full(size, part, np.int32)]
        prints = pa.array(np.concatenate(held).view(np.int64))
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), prints, pa.nulls(size, pa.int64())], LINK_FIELDS)

    def finished() -> Iterator[pa.RecordBatch]:
        if part:
            yield handed_on()
        elif size > 1:
            a, b = _links(np.concatenate(held), None)
            if len(a):
                yield _link_batch(a, b)

    for batch in batches:
        choice, cell, prints = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("choice", "cell", "print"))
        if not len(prints):
            continue
        cuts = np.flatnonzero((choice[1:] != choice[:-1]) | (cell[1:] != cell[:-1])) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(prints)]):
            here = (int(choice[begin]), int(cell[begin]))
            if here != key:
                yield from finished()
                key, held, size, part = here, [], 0, 0
            while begin < end:
                if size == PART:
                    yield handed_on()
                    held, size, part = [], 0, part + 1
                take = min(end - begin, PART - size)
                held.append(prints[begin : begin + take].view(np.uint64))
                size, begin = size + take, begin + take
    yield from finished()


def _two_parts(keys, left: pa.Table, right: pa.Table) -> pa.Table:  # noqa: ANN001
    a, b = (np.sort(t.column("print").to_numpy().view(np.uint64)) for t in (left, right))
    same = len(left) > 0 and left.column("part")[0].as_py() == left.column("other")[0].as_py()
    x, y = _links(a, None) if same else _links(a, b)
    return pa.table({"a": x.view(np.int64), "b": y.view(np.int64)})


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints that chains of at most MAX_BITS connect."""
    cells = prints.select("print").mapInArrow(_cell_batches, "choice smallint, cell bigint, print bigint")
    placed = cells.repartition("choice", "cell").sortWithinPartitions("choice", "cell")
    found = stored(
        placed.mapInArrow(_cells_in_order, "choice smallint, cell bigint, part int, a bigint, b bigint"), "simhash-cells")
    links = found.where("part IS NULL").select("a", "b")
    parts = found.where("part IS NOT NULL").select("choice", "cell", "part", F.col("a").alias("print"))
    if not parts.take(1):
        return links.distinct()
    last = parts.groupBy("choice", "cell").agg(F.max("part").alias("last"))
    spread = parts.join(last, ["choice", "cell"])
    lefts = spread.withColumn("other", F.explode(F.sequence("part", "last")))
    # New names for all columns: both sides come from the same frame, which the cogroup could not tell apart.
    rights = spread.select(
        *(F.col(c).alias(c) for c in ("choice", "cell", "print")),
        F.col("part").alias("other"), F.explode(F.sequence(F.lit(0), "part")).alias("part"))
    pair = ["choice", "cell", "part", "other"]
    compared = lefts.groupBy(*pair).cogroup(rights.groupBy(*pair)).applyInArrow(_two_parts, "a bigint, b bigint")
    return links.union(compared).distinct()


# --- components ---------------------------------------------------------------------------------


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def components(links: DataFrame, keep: str = "simhash-links") -> DataFrame:
    """(node, root): the smallest node of each component, by alternating star operations.

    In a round every node ties its larger neighbours to its smallest neighbour, then itself and its
    smaller neighbours to the smallest of them. The links shrink to stars around the roots.
    """
    links = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), keep)
    before = None
    while (now := _state(links)) != before:
        before = now
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (
            lookup_join(both.where("b > a"), least, "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            lookup_join(large, low, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
            .where("a != b").distinct()
        )
        links = stored(small, keep)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _of_print(nodes: DataFrame) -> DataFrame:
    """(print, first_id, root) of distinct fingerprints (print, first_id); a root stands for its component."""
    roots = components(fingerprint_links(nodes))
    return nodes.join(roots, nodes["print"] == roots["node"], "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per document."""
    marked = stored(fingerprints(docs), "simhash-prints")
    nodes = stored(marked.groupBy("print").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    rooted = _of_print(nodes)
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = stored(lookup_join(rooted, smallest, "root").select("print", "component_id"), "simhash-components")
    return lookup_join(marked, of_print, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def _with_print(docs: DataFrame, name: str) -> DataFrame:
    """The documents in their own columns, and their fingerprint in one more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(shingle_hashes(x.as_py())) for x in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints.view(np.int64))], [*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def one_per_group(docs: DataFrame) -> DataFrame:
    """Of each component of ``near_duplicates`` one document, in the columns of ``docs``.

    It is the one with the smallest id; of several rows with that id the one with the smallest
    fingerprint, then the first by text and the other columns. Rows are chosen, not ids: a text that
    nothing resembles stays, whatever other text repeats its id. Rows without an id belong to no
    component and all stay.
    """
    mark, rank = "__print__", "__rank__"
    marked = stored(_with_print(docs.where("doc_id IS NOT NULL"), mark), "simhash-documents")
    nodes = stored(marked.groupBy(F.col(mark).alias("print")).agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    first = F.min(F.struct("first_id", "print"))["print"]
    stay = stored(_of_print(nodes).groupBy("root").agg(first.alias(mark)).select(mark), "simhash-stay")
    order = ["doc_id", "text", *(F.col(c).cast("string") for c in docs.columns if c not in ("doc_id", "text"))]
    # The rank limit applies before the shuffle too: a task sends one copy of a text, however many it holds.
    one = marked.withColumn(rank, F.row_number().over(W.partitionBy(mark).orderBy(*order))).where(F.col(rank) == 1)
    return one.join(stay, mark, "left_semi").select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
