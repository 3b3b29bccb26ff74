"""The trie of conversation prefixes, with totals over its subtrees by time-forward processing.

Every distinct sequence of first turns is a node; conversations that begin with it are its members.

**Nodes.** A turn's digest is 127 bits of BLAKE2 over role and text; a prefix is the polynomial of its
turns' digests modulo 2^127 - 1. The prefixes of a conversation are running sums, so a conversation
of any length is cut over many tasks: each sums its own block of turns, and a block that begins
inside a conversation adds the sum of the blocks before it. Members are counted by a hash aggregate
on (depth, prefix).

**Shards.** A node with many members (``heavy``: the square root of the rows, or more) is kept for
the last step; there are at most (rows / heavy) of them on a level. Below a heavy node, each child with
fewer members begins a shard of its own, and every BAND levels further down a new shard begins. A
shard so never has more than heavy * BAND nodes, however the members are spread.

**Totals.** In a shard the nodes are sorted by reverse level order (Spark's external sort) and passed
once: a node takes its children's messages from a priority queue, adds them to its own figures and
sends the sum on to its parent. The queue spills sorted runs to an unnamed file of the task, which
ends with it. Then the same is done across shard roots: roots are the nodes of the next level, their
shards BAND times as high, until one level covers the deepest conversation; going back down, the
roots' whole totals enter the shards above them as messages. Totals of the uppermost roots are added
up per heavy parent, and the heavy nodes are passed in the same way.

Defined cases: rows without a conv_id belong to no conversation; a missing role or text is empty; a
missing turn comes first; turns of one conversation with an equal number follow by role, then text,
and repeated rows stay repeated turns; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.functions.joins import lookup_join
from tidemark.llm.common import stored

PRIME = (1 << 127) - 1
BASE = 0x2545F4914F6CDD1D9E3779B97F4A7C15
LOW = (1 << 64) - 1
HEAVY = 64  # members from which a node is passed with the heavy ones, at least
BAND = 1024  # levels of a shard
QUEUE = 1 << 17  # messages a task holds before it spills
CHUNK = 4096  # conversation ids in one piece of text
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = ["depth", "a", "b"]
TOTALS = ["kids", "leaves", "saved"]


def _halves(value: int) -> tuple[int, int]:
    low = value & LOW
    return value >> 64, low - (1 << 64) if low >> 63 else low


def _whole(high: int, low: int) -> int:
    return (high << 64) | (low & LOW)


def turn_digest(role: str, text: str) -> int:
    """A number from 1 to PRIME - 1 that stands for one turn."""
    name = role.encode("utf-8", "surrogatepass")
    data = len(name).to_bytes(8, "little") + name + text.encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(data, digest_size=16).digest(), "little") % (PRIME - 1) + 1


# --- turns in order -----------------------------------------------------------------------------


def _numbered_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns sorted by conversation: each one's number in this block's part of its conversation."""
    block, last, nth = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        numbers, digests, words = [], [], []
        convs = batch.column("conv_id").to_pylist()
        for conv, role, text in zip(convs, batch.column("role").to_pylist(), batch.column("text").to_pylist()):
            nth = nth + 1 if conv == last else 1
            last = conv
            numbers.append(nth)
            digests.append(_halves(turn_digest(role, text)))
            words.append(len(text.encode("utf-8", "surrogatepass").split()))  # bytes: ASCII spaces only
        high, low = zip(*digests) if digests else ((), ())
        columns = [[block] * len(convs), convs, numbers, high, low, words]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["block", "conv_id", "nth", "high", "low", "words"])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, high, low, words): one row per turn, its place counted from 1, and its digest."""
    empty = {c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")}
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", empty["role"], empty["text"], F.rand(11).alias("salt"))
    order = ["conv_id", "turn", "role", "text", "salt"]  # the salt lets repeated rows fall into several blocks
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    names = ("block", "conv_id", "nth", "high", "low", "words")
    found = stored(
        dealt.select("conv_id", "role", "text").mapInArrow(_numbered_batches, ", ".join(f"{n} bigint" for n in names)),
        "trie-turns")
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = (
        found.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(earlier)).where("before IS NOT NULL").drop("n")
    )
    return found.join(before, ["conv_id", "block"], "left").select(
        "conv_id", (F.col("nth") + F.coalesce("before", F.lit(0))).alias("place"), "high", "low", "words")


# --- prefixes -----------------------------------------------------------------------------------


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns sorted by conversation and place: the sums up to and before each, over this block only."""
    block, last, total, power = TaskContext.get().partitionId(), None, 0, 0
    names = ["block", "conv_id", "depth", "a", "b", "pa", "pb", "words"]
    for batch in batches:
        sums, before = [], []
        columns = {c: batch.column(c).to_pylist() for c in ("conv_id", "place", "high", "low", "words")}
        for conv, place, high, low in zip(*(columns[c] for c in ("conv_id", "place", "high", "low"))):
            if conv != last:
                last, total, power = conv, 0, pow(BASE, place, PRIME)
            before.append(_halves(total))
            total = (total + _whole(high, low) * power) % PRIME
            power = power * BASE % PRIME
            sums.append(_halves(total))
        a, b = zip(*sums) if sums else ((), ())
        pa_, pb = zip(*before) if before else ((), ())
        rows = [[block] * len(a), columns["conv_id"], columns["place"], a, b, pa_, pb, columns["words"]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names)


def _carry_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block sums sorted by conversation and block: the sum of the blocks before each."""
    last, total = None, 0
    for batch in batches:
        rows = []
        for conv, block, high, low in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "block", "a", "b"))):
            total = total if conv == last else 0
            last = conv
            rows.append((conv, block, *_halves(total)))
            total = (total + _whole(high, low)) % PRIME
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["conv_id", "block", "ca", "cb"])


def _carried_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = ["conv_id", "depth", "a", "b", "pa", "pb", "words"]
    for batch in batches:
        columns = {c: batch.column(c).to_numpy(zero_copy_only=False).copy() for c in kept}
        carry = batch.column("ca")
        if carry.null_count < len(carry):
            for i in np.flatnonzero(carry.is_valid().to_numpy(zero_copy_only=False)).tolist():
                more = _whole(carry[i].as_py(), batch.column("cb")[i].as_py())
                for x, y in (("a", "b"), ("pa", "pb")):
                    columns[x][i], columns[y][i] = _halves((_whole(int(columns[x][i]), int(columns[y][i])) + more) % PRIME)
        yield pa.RecordBatch.from_arrays([pa.array(columns[c]) for c in kept], kept)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, pa, pb, words): each turn's prefix and the one before it."""
    kinds = lambda *names: ", ".join(f"{n} bigint" for n in names)
    dealt = turns.repartitionByRange("conv_id", "place").sortWithinPartitions("conv_id", "place")
    sums = stored(
        dealt.mapInArrow(_sum_batches, kinds("block", "conv_id", "depth", "a", "b", "pa", "pb", "words")), "trie-sums")
    blocks = sums.groupBy("conv_id", "block").agg(*(F.max_by(c, "depth").alias(c) for c in ("a", "b")))
    several = blocks.withColumn("n", F.count("*").over(W.partitionBy("conv_id"))).where("n > 1").drop("n")
    carries = (
        several.repartition("conv_id").sortWithinPartitions("conv_id", "block")
        .mapInArrow(_carry_batches, kinds("conv_id", "block", "ca", "cb"))
    )
    joined = sums.join(carries, ["conv_id", "block"], "left")
    return stored(joined.mapInArrow(_carried_batches, kinds("conv_id", "depth", "a", "b", "pa", "pb", "words")), "trie-prefixes")


# --- time-forward processing --------------------------------------------------------------------


class SpillingQueue:
    """A priority queue of (depth counted downwards, a, b, kids, leaves, saved) that spills sorted runs."""

    _ENTRY = struct.Struct("<6q")

    def __init__(self, limit: int | None = None) -> None:
        self.limit, self.heap, self.runs = limit or QUEUE, [], []

    def push(self, entry: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.limit:
            self.heap.sort()
            half = len(self.heap) // 2
            run = self._run(self.heap[half:])
            del self.heap[half:]
            heapq.heappush(self.runs, (next(run), len(self.runs), run))

    def _run(self, entries: list[tuple[int, ...]]) -> Iterator[tuple[int, ...]]:
        with tempfile.TemporaryFile() as file:
            file.writelines(self._ENTRY.pack(*e) for e in entries)
            file.seek(0)
            entries.clear()
            while data := file.read(4096 * self._ENTRY.size):
                yield from self._ENTRY.iter_unpack(data)

    def first(self) -> tuple[int, ...] | None:
        tops = [q for q in (self.heap[:1], [self.runs[0][0]] if self.runs else []) if q]
        return min(q[0] for q in tops) if tops else None

    def pop(self) -> tuple[int, ...]:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            entry, number, run = heapq.heappop(self.runs)
            if (following := next(run, None)) is not None:
                heapq.heappush(self.runs, (following, number, run))
            return entry
        return heapq.heappop(self.heap)


def _forward_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards in reverse level order: each node's figures with those of all below it in the shard.

    A stub stands for the root of a shard below: it only sends its figures on.
    """
    shard, queue = None, SpillingQueue()
    names = ["sa", "sb", *NODE, "pd", "pa", "pb", *TOTALS, "stub", "top"]
    for batch in batches:
        totals, kept = [], []
        for sa, sb, depth, a, b, pd, pa_, pb, kids, leaves, saved, stub, top in zip(
                *(batch.column(c).to_pylist() for c in names)):
            if (sa, sb) != shard:
                shard, queue = (sa, sb), SpillingQueue()
            if not stub:
                while (head := queue.first()) is not None and head[:3] == (-depth, a, b):
                    _, _, _, more_kids, more_leaves, more_saved = queue.pop()
                    kids, leaves, saved = kids + more_kids, leaves + more_leaves, saved + more_saved
                leaves = leaves if kids or leaves else 1
                totals.append((kids, leaves, saved))
            kept.append(not stub)
            if stub or not top:
                queue.push((-pd, pa_, pb, 1, leaves, saved))
        rest = batch.filter(pa.array(kept, pa.bool_()))
        new = dict(zip(TOTALS, zip(*totals) if totals else ((),) * 3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(new[c], pa.int64()) if c in new else rest.column(c) for c in rest.schema.names], rest.schema.names)


def _forward(rows: DataFrame) -> DataFrame:
    order = ["sa", "sb", F.desc("depth"), "a", "b"]
    kinds = StructType([StructField(f.name, f.dataType if f.name in ("stub", "top") else LongType()) for f in rows.schema])
    return rows.repartition("sa", "sb").sortWithinPartitions(*order).mapInArrow(_forward_batches, kinds)


def _anchored(light: DataFrame, marks: DataFrame, at: Column, height: int, deep: bool, a: str, b: str) -> DataFrame:
    """The first node of the shard that a node's ancestor on level ``at`` is in, for shards of ``height`` levels."""
    low = (F.floor(at / height) * height).cast("long")
    if not deep:
        return light.withColumns({a: F.col("fa"), b: F.col("fb")})
    marked = light.withColumn("_low", F.when(low > F.col("f"), low))
    upper = marked.where("_low IS NULL").withColumns({a: F.col("fa"), b: F.col("fb")})
    lower = marked.where("_low IS NOT NULL").join(
        marks.select(F.col("conv_id").alias("conv"), F.col("depth").alias("_low"), F.col("a").alias(a), F.col("b").alias(b)),
        ["conv", "_low"])
    return upper.unionByName(lower).drop("_low")


def _light_totals(light: DataFrame, marks: DataFrame, deepest: int, band: int) -> DataFrame:
    """Whole totals of the light nodes: up through the levels of shards, and down again."""
    levels = 1
    while band**levels <= deepest:
        levels += 1
    nodes, own, stubs, complete = light, {}, {}, None
    for k in range(1, levels + 1):
        height, deep = band**k, deepest >= band**k
        rows = _anchored(nodes, marks, F.col("depth"), height, deep, "sa", "sb").withColumns(
            {"stub": F.lit(False), "top": (F.col("depth") == F.col("f")) | (F.col("depth") % height == 0)})
        own[k] = stored(rows, f"trie-level-{k}")
        if not deep:
            complete = stored(_forward(own[k]), f"trie-whole-{k}")
            break
        below = own[k].where("top AND depth > f").drop("sa", "sb")
        below = _anchored(below, marks, F.col("depth") - 1, height, deep, "sa", "sb").withColumn("stub", F.lit(True))
        stubs[k] = stored(below, f"trie-stubs-{k}")
        silent = stubs[k].withColumns({c: F.lit(0).cast("long") for c in TOTALS})
        local = stored(_forward(own[k].unionByName(silent)), f"trie-local-{k}")
        roots = local.where("top").drop("sa", "sb", "pd", "pa", "pb", "stub", "top")
        # On the next level a root's parent is the first node of the shard above it.
        above = stubs[k].select(
            *NODE, F.greatest(F.col("f"), F.floor((F.col("depth") - 1) / height) * height).cast("long").alias("pd"),
            F.col("sa").alias("pa"), F.col("sb").alias("pb"))
        nodes = roots.join(above, NODE, "left").withColumns(
            {c: F.coalesce(c, F.lit(0)) for c in ("pd", "pa", "pb")})
    for k in range(levels - 1, 0, -1):
        whole = complete.select(*NODE, *TOTALS)
        told = stubs[k].drop(*TOTALS).join(whole, NODE).withColumn("kids", F.lit(0).cast("long"))
        complete = stored(_forward(own[k].unionByName(told)), f"trie-whole-{k}")
    return complete


# --- conversations that end in a node -----------------------------------------------------------


def _chunk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ends sorted by node and conversation: the ids as pieces of text, in order."""
    block, key, held, nth = TaskContext.get().partitionId(), None, [], 0
    names = [*NODE, "block", "nth", "ids"]
    kinds = [pa.int64()] * 5 + [pa.string()]

    def piece() -> tuple:
        return (*key, block, nth, ",".join(map(str, held)))

    for batch in batches:
        rows = []
        for depth, a, b, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id"))):
            if held and ((depth, a, b) != key or len(held) == CHUNK):
                rows.append(piece())
                held, nth = [], nth + 1
            key = (depth, a, b)
            held.append(conv)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(piece(), kinds)], names)


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by node and order: the SHA-256 of each node's pieces, joined with commas."""
    key, state = None, None
    kinds = [pa.int64()] * 3 + [pa.string()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [*NODE, "ends_sha256"])

    for batch in batches:
        rows = []
        for depth, a, b, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
            if (depth, a, b) == key:
                state.update(b"," + ids.encode())
                continue
            if key is not None:
                rows.append((*key, state.hexdigest()))
            key, state = (depth, a, b), hashlib.sha256(ids.encode())
        if rows:
            yield made(rows)
    if key is not None:
        yield made([(*key, state.hexdigest())])


def _end_digests(rows: DataFrame, members: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of the nodes in which conversations end."""
    lengths = rows.groupBy("conv_id").agg(
        F.max("depth").alias("depth"), *(F.max_by(c, "depth").alias(c) for c in ("a", "b")))
    ends = members.join(lengths, "conv_id", "left").select(
        *(F.coalesce(c, F.lit(0)).alias(c) for c in NODE), "conv_id")
    order = [*NODE, "conv_id"]
    dealt = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = dealt.mapInArrow(_chunk_batches, "depth bigint, a bigint, b bigint, block bigint, nth bigint, ids string")
    met = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "block", "nth")
    return met.mapInArrow(_digest_batches, "depth bigint, a bigint, b bigint, ends_sha256 string")


# --- the trie -----------------------------------------------------------------------------------


def prefix_trie(turns: DataFrame, members: DataFrame, heavy: int | None = None, band: int | None = None) -> DataFrame:
    """One row per node: its smallest member, its parent's, its counts, totals and ends.

    ``turns`` are rows as of ``numbered_turns``; ``members`` holds each conv_id once, also of those
    without a turn. Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. ``heavy`` and ``band`` bound the shards.
    """
    heavy, band = heavy or HEAVY, band or BAND
    rows = prefixes(turns)
    size = rows.agg(F.count("*").alias("n"), F.max("depth").alias("deepest")).first()
    heavy, deepest = max(heavy, math.isqrt(size["n"])), size["deepest"] or 0

    counted = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv"), F.count("*").alias("n"),
        *(F.max(c).alias(c) for c in ("pa", "pb", "words")))
    root = members.agg(F.min("conv_id").alias("conv"), F.count("*").alias("n")).where("n > 0").select(
        *(F.lit(0).cast("long").alias(c) for c in NODE), "conv", "n",
        *(F.lit(0).cast("long").alias(c) for c in ("pa", "pb", "words")))
    is_heavy = (F.col("n") >= heavy) | (F.col("depth") == 0)
    nodes = stored(
        counted.unionByName(root).select(
            *NODE, (F.col("depth") - 1).alias("pd"), "pa", "pb", "conv", "n",
            ((F.col("n") - 1) * F.col("words")).alias("saved"), is_heavy.alias("heavy")),
        "trie-nodes")

    many = nodes.where("heavy").select(*NODE)
    spread = F.xxhash64(*NODE)  # a heavy node's rows are met through a shuffle of their own, which can be split
    below = rows.withColumn("_spread", spread).join(many.withColumn("_spread", spread), [*NODE, "_spread"], "left_anti")
    first = stored(
        below.groupBy(F.col("conv_id").alias("conv")).agg(
            F.min("depth").alias("f"), F.min_by("a", "depth").alias("fa"), F.min_by("b", "depth").alias("fb")),
        "trie-first")
    none = {c: F.lit(0).cast("long") for c in ("kids", "leaves")}
    light = lookup_join(nodes.where("NOT heavy").drop("heavy"), first, "conv", "inner").withColumns(none)
    marks = rows.where(F.col("depth") % band == 0).select("conv_id", *NODE)
    whole = _light_totals(light, marks, deepest, band).drop("sa", "sb", "pd", "pa", "pb", "stub", "top", "f", "fa", "fb")
    # The parents again from the nodes: on the way up the roots had others.
    whole = nodes.where("NOT heavy").select(*NODE, "pd", "pa", "pb").join(whole, NODE)

    sent = first.select(F.col("f").alias("depth"), F.col("fa").alias("a"), F.col("fb").alias("b")).distinct()
    sent = whole.join(sent, NODE).groupBy("pd", "pa", "pb").agg(
        F.count("*").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("more"))
    upper = nodes.where("heavy").drop("heavy").join(
        sent.withColumnsRenamed({"pd": "depth", "pa": "a", "pb": "b"}), NODE, "left")
    upper = upper.select(
        *NODE, "pd", "pa", "pb", "conv", "n", F.coalesce("kids", F.lit(0)).alias("kids"),
        F.coalesce("leaves", F.lit(0)).alias("leaves"), (F.col("saved") + F.coalesce("more", F.lit(0))).alias("saved"),
        *(F.lit(0).cast("long").alias(c) for c in ("sa", "sb")), F.lit(False).alias("stub"), (F.col("depth") == 0).alias("top"))
    upper = _forward(upper).drop("sa", "sb", "stub", "top")

    parents = nodes.select(
        F.col("depth").alias("pd"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv").alias("parent"))
    known = whole.unionByName(upper).join(parents, ["pd", "pa", "pb"], "left")
    return known.join(_end_digests(rows, members), NODE, "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def rebuilt_conversations(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, members) where each conversation begins with the first turns of its group's first one.

    Conversation c takes the first h turns of c - c % group (none if that is absent) and then its own
    after its first h, with h = crc32 of c as text, modulo ``most``.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % most
    base = F.col("conv_id") - F.col("conv_id") % group
    members = stored(turns.groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id"), "trie-members")
    heads = turns.where((F.col("conv_id") % group == 0) & (F.col("place") < most)).withColumnRenamed("conv_id", "base")
    borrowed = members.select("conv_id", base.alias("base"), h.alias("h")).join(heads, "base").where("place <= h")
    have = heads.groupBy("base").agg(F.count("*").alias("have"))
    own = turns.select("*", base.alias("base"), h.alias("h")).where("place > h")
    moved = F.col("place") - F.col("h") + F.least("h", F.coalesce("have", F.lit(0)))
    own = lookup_join(own, have, "base").withColumn("place", moved)
    names = ["conv_id", "place", "high", "low", "words"]
    return borrowed.select(*names).unionByName(own.select(*names)), members
