"""Benchmark passages in documents, with edits: q-gram lemma, diagonal bands, banded alignment.

Text and passages are compared as bytes, with A-Z lower-cased and each run of other ASCII than
letters and digits as one space. A place that holds a passage of m bytes with at most k edits
shares at least m - q + 1 - k q of its q-grams, on diagonals at most k apart. Shared q-grams are
counted in bands of 2 (k + 1) diagonals that overlap by half; bands that reach the bound are
aligned, and those within k edits are matches. Of matches of one passage that overlap the one with
fewer edits stays, then the earlier; every other place is reported. A passage with fewer than q bytes
has no q-gram: it is looked up among the words of the text, whole words and without edits.

The passages are cut into blocks by a hash and stored; every block meets all documents in a job of its
own, so the driver and a task hold one block of bounded size at a time.

Defined cases: a missing or empty text holds nothing; a missing passage, and one without a letter or
digit, is skipped; equal passages are found each under its own id, repeated rows of the benchmark
once; repeated documents are searched each for itself; other columns are ignored; an empty table on
either side gives no rows.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.chunks import pieces, text_bytes
from tidemark.llm.common import stored

Q = 8
EDIT_RATE = 0.08
BLOCK_BYTES = 4 << 20  # of passages held by a task
SCAN_BYTES = 4 << 20  # of text whose q-grams are looked up at once
TABLE_BITS = 21
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[*range(48), *range(58, 65), *range(91, 97), *range(123, 128)]] = 32


def folded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The compared bytes, and which bytes of the input they are."""
    low = _FOLD[data]
    keep = np.ones(len(low), bool)
    if len(low):
        keep[1:] = (low[1:] != 32) | (low[:-1] != 32)
    return low[keep], keep


def folded_passage(text: str | None) -> bytes:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return folded(data)[0].tobytes().strip(b" ")


def edit_budget(size: int, rate: float = EDIT_RATE) -> int:
    """Edits allowed in a passage, never so many that the q-gram bound would vanish."""
    return max(0, min(int(rate * size), (size - Q) // Q))


def grams(data: np.ndarray) -> np.ndarray:
    """The Q bytes at every place, as one number."""
    if len(data) < Q:
        return np.empty(0, np.uint64)
    two = data[:-1].astype(np.uint16) | (data[1:].astype(np.uint16) << 8)
    four = two[:-2].astype(np.uint32) | (two[2:].astype(np.uint32) << 16)
    return four[:-4].astype(np.uint64) | (four[4:].astype(np.uint64) << np.uint64(32))


def _slot(values: np.ndarray) -> np.ndarray:
    return (values * MULTIPLIER) >> np.uint64(64 - TABLE_BITS)


class PassageIndex:
    """The q-grams of a block of passages, where they stand, and each passage's bounds."""

    def __init__(self, passages: list[tuple[int | None, bytes]], rate: float = EDIT_RATE) -> None:
        self.passages = [(i, p) for i, p in passages if len(p) >= Q]
        self.short: dict[int, tuple[np.ndarray, list[list[int | None]]]] = {}  # by size: sorted numbers, their ids
        by_size: dict[int, dict[int, list[int | None]]] = {}
        for i, p in passages:
            if 0 < len(p) < Q:
                by_size.setdefault(len(p), {}).setdefault(int.from_bytes(p, "little"), []).append(i)
        for size, ids in by_size.items():
            keys = sorted(ids)
            self.short[size] = np.array(keys, np.uint64), [ids[k] for k in keys]
        sizes = np.array([len(p) for _, p in self.passages], np.int64)
        self.edits = np.array([edit_budget(n, rate) for n in sizes], np.int64)
        self.bound = sizes - Q + 1 - self.edits * Q
        self.longest = int(sizes.max(initial=0))
        each = [grams(np.frombuffer(p, np.uint8)) for _, p in self.passages]
        every = np.concatenate(each) if each else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(each)), [len(g) for g in each])
        place = np.concatenate([np.arange(len(g)) for g in each]) if each else np.empty(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.keys, first, self.counts = np.unique(every[order], return_index=True, return_counts=True)
        self.first, self.owner, self.place = first, owner[order], place[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[_slot(self.keys)] = True

    def shared(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, diagonal) of every q-gram the text shares with a passage."""
        owners, diagonals = [], []
        for begin in range(0, max(0, len(data) - Q + 1), SCAN_BYTES):
            values = grams(data[begin : begin + SCAN_BYTES + Q - 1])
            at = np.flatnonzero(self.table[_slot(values)])
            found = np.searchsorted(self.keys, values[at])
            found[found == len(self.keys)] = 0
            right = self.keys[found] == values[at]
            at, found = at[right] + begin, found[right]
            n = self.counts[found]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            entry = np.repeat(self.first[found], n) + step
            owners.append(self.owner[entry])
            diagonals.append(np.repeat(at, n) - self.place[entry])
        if not owners:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(owners), np.concatenate(diagonals)

    def candidates(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, first diagonal) of every band with enough shared q-grams."""
        owner, diagonal = self.shared(data)
        if not len(owner):
            return owner, diagonal
        width = self.edits + 1
        bands = (len(data) + self.longest) + 3
        band = (diagonal + self.longest) // width[owner] + 1
        key, count = np.unique(owner * bands + band, return_counts=True)
        # A band with its successor; a lone successor also pairs with the empty band before it.
        after = np.searchsorted(key, key + 1)
        follows = (after < len(key)) & (key[np.minimum(after, len(key) - 1)] == key + 1)
        total = count + np.where(follows, count[np.minimum(after, len(key) - 1)], 0)
        good = total >= self.bound[key // bands]
        who, which = key[good] // bands, key[good] % bands
        return who, (which - 1) * width[who] - self.longest


def banded_distance(passage: np.ndarray, text: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of the passage in the text near each start, and where such a place ends.

    Diagonals start .. start + width - 1 are computed, for all starts at once. The text is padded
    with a byte that equals nothing, so places off its ends cost edits.
    """
    m, n = len(passage), len(starts)
    pad = np.zeros(m + width + 1, np.uint8)
    padded = np.concatenate((pad, text, pad))
    base = np.clip(starts, -(m + width), len(text)) + len(pad)
    step = np.arange(width)
    row = np.zeros((n, width), np.int32)
    for j in range(m):
        here = padded[(base + j)[:, None] + step]
        new = row + (here != passage[j])
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(new - step, axis=1) + step
    best = row.min(axis=1)
    last = width - 1 - np.argmin(row[:, ::-1], axis=1)
    return best, base - len(pad) + m + last


def _matches(index: PassageIndex, data: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(passage, edits, first, end) of every place of a passage in one text; places of one never overlap."""
    who, first = index.candidates(data)
    for owner in np.unique(who).tolist():
        passage = np.frombuffer(index.passages[owner][1], np.uint8)
        budget = int(index.edits[owner])
        width = 2 * (budget + 1) + 2 * budget
        found: set[tuple[int, int]] = set()
        starts = first[who == owner] - budget
        for begin in range(0, len(starts), 1024):
            edits, ends = banded_distance(passage, data, starts[begin : begin + 1024], width)
            good = edits <= budget
            found.update(zip(edits[good].tolist(), ends[good].tolist()))
        taken: list[tuple[int, int]] = []
        for edits_here, end in sorted(found):
            if any(a < end <= b for a, b in taken):
                continue
            # The same backwards from the end found gives the beginning.
            head = data[max(0, end - len(passage) - 2 * budget) : end][::-1]
            _, length = banded_distance(passage[::-1], head, np.array([-budget]), 2 * budget + 1)
            place = max(0, end - int(length[0])), min(end, len(data))
            at = bisect.bisect_left(taken, place)
            if not any(a < place[1] and place[0] < b for a, b in taken[max(0, at - 1) : at + 1]):
                taken.insert(at, place)
                yield owner, edits_here, *place


def _short_places(index: PassageIndex, low: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int | None, int, int]]:
    """(text, passage id, first, end) of the short passages among the words of a piece's texts.

    ``low`` are the folded bytes of all texts, ``begins`` the n + 1 places where these begin and end.
    """
    if not index.short or not len(low):
        return
    edge = np.zeros(len(low) + 1, bool)  # whether a text ends or begins here
    edge[begins] = True
    starts = np.flatnonzero(low != 32)
    starts = starts[edge[starts] | (low[np.maximum(starts - 1, 0)] == 32)]
    windows = grams(np.concatenate((low, np.zeros(Q, np.uint8))))[starts]
    inner = np.concatenate((np.cumsum(edge), np.full(Q, edge.sum())))
    after = np.concatenate((low, np.full(Q, 32, np.uint8)))
    for size, (keys, ids) in index.short.items():
        values = windows & np.uint64((1 << (8 * size)) - 1)
        at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
        ends = starts + size
        good = (keys[at] == values) & (ends <= len(low)) & (inner[starts] == inner[ends - 1])
        good &= (after[np.minimum(ends, len(low))] == 32) | edge[np.minimum(ends, len(low))]
        for i in np.flatnonzero(good).tolist():
            text = int(np.searchsorted(begins, starts[i], side="right")) - 1
            for passage in ids[int(at[i])]:
                yield text, passage, int(starts[i]), int(ends[i])


def _suspects(index: PassageIndex, low: np.ndarray, begins: np.ndarray) -> list[int]:
    """The texts of a piece that touch a candidate band of the piece taken as one text.

    A q-gram of a text is one of the piece as well, so no text with a candidate is missed.
    """
    who, first = index.candidates(low)
    if not len(who):
        return []
    sizes = np.array([len(p) for _, p in index.passages])
    slack = 3 * index.edits[who] + 2
    low_doc = np.searchsorted(begins, first - slack, side="right") - 1
    high_doc = np.searchsorted(begins, first + sizes[who] + slack, side="right") - 1
    touched = np.zeros(len(begins), np.int64)
    np.add.at(touched, np.clip(low_doc, 0, len(begins) - 1), 1)
    np.add.at(touched, np.clip(high_doc + 1, 0, len(begins) - 1), -1)
    return np.flatnonzero((np.cumsum(touched) > 0)[:-1] & (np.diff(begins) > 0)).tolist()


def _places(index: PassageIndex, column: pa.Array) -> Iterator[tuple[int, int | None, int, int, int]]:
    """(text, passage id, edits, first, end) of every place in a batch's texts, in characters."""
    data, offsets = text_bytes(column)
    low, keep = folded(data)
    begins = np.concatenate(([0], np.cumsum(keep)))[offsets]
    source = np.flatnonzero(keep)

    def chars(text: int, first: int, end: int) -> tuple[int, int]:
        begin = offsets[text]
        first, end = (len(data[begin:p].tobytes().decode("utf-8", "ignore")) for p in (source[first], source[end - 1] + 1))
        return first, end

    for i in _suspects(index, low, begins) if index.passages else ():
        # Folded on its own: a run of other characters at its begin belongs to it alone.
        text, kept = folded(data[offsets[i] : offsets[i + 1]])
        source_here = np.flatnonzero(kept) + offsets[i]
        for owner, edits, first, end in _matches(index, text):
            begin = offsets[i]
            place = (len(data[begin:p].tobytes().decode("utf-8", "ignore")) for p in (source_here[first], source_here[end - 1] + 1))
            yield i, index.passages[owner][0], edits, *place
    for i, passage, first, end in _short_places(index, low, begins):
        yield i, passage, 0, *chars(i, first, end)


def _search(batches: Iterator[pa.RecordBatch], block: list[tuple[int | None, bytes]], rate: float, schema: pa.Schema):
    index = PassageIndex(block, rate)
    for batch in pieces(batches):
        ids = batch.column("doc_id")
        rows = [(ids[i].as_py(), *place) for i, *place in _places(index, batch.column("text"))]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _clean(batches: Iterator[pa.RecordBatch], block: list[tuple[int | None, bytes]], rate: float):
    """The rows whose text holds no passage."""
    index = PassageIndex(block, rate)
    for batch in pieces(batches):
        keep = np.ones(batch.num_rows, bool)
        keep[list({i for i, *_ in _places(index, batch.column("text"))})] = False
        yield batch.filter(pa.array(keep))


def _passages(benchmark: DataFrame) -> DataFrame:
    """(item_id, passage): the folded passages, each row once."""
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passages = [folded_passage(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(passages, pa.binary())], ["item_id", "passage"])

    rows = benchmark.select("item_id", "text").where("text IS NOT NULL").mapInArrow(run, f"item_id {kind}, passage binary")
    return rows.where("length(passage) > 0").distinct()


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, bytes]]]:
    """The stored passages in blocks of at most BLOCK_BYTES (a longer passage alone may have more), one at a time."""
    passages = stored(_passages(benchmark), "passages")
    total = passages.agg(F.sum(F.length("passage")).alias("n"), F.max(F.length("passage")).alias("most")).first()
    if not total["n"]:
        return
    number, most = 1, max(BLOCK_BYTES, total["most"])
    while True:
        block = F.pmod(F.xxhash64("item_id", "passage"), F.lit(number))
        largest = passages.groupBy(block.alias("block")).agg(F.sum(F.length("passage")).alias("n")).agg(F.max("n")).first()[0]
        if largest <= most:
            break
        number *= 2
    for i in range(number):
        if rows := passages.where(block == i).collect():
            yield sorted(((r["item_id"], bytes(r["passage"])) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def find_passages(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """One row per place of a passage in a document: edits and the place, in characters of the text."""
    ids = [docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()]
    names = f"doc_id {ids[0]}, item_id {ids[1]}, edits int, start bigint, end bigint"
    spark = docs.sparkSession
    result = spark.createDataFrame([], names)
    schema = to_arrow_schema(result.schema)
    for number, block in enumerate(_blocks(benchmark)):
        found = docs.select("doc_id", "text").mapInArrow(
            lambda batches, block=block: _search(batches, block, rate, schema), names)
        # The first block's places need no store of their own; with more of them each is a job that ends here.
        result = found if not number else stored(result.unionByName(found), "passage-places")
    return result


def without_passages(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """The documents that hold no passage, in their own columns: rows are judged, ids are not looked at."""
    for number, block in enumerate(_blocks(benchmark)):
        docs = stored(docs, "passage-clean") if number else docs
        docs = docs.mapInArrow(lambda batches, block=block: _clean(batches, block, rate), docs.schema)
    return docs
