"""Token ids in shard files, each a wavelet matrix: one compressed file that answers queries.

A shard holds the ids of consecutive documents as bit planes, highest bit first; each plane is
stably partitioned by the one before. With counts of ones per block (rank) and a search in them
(select) a shard gives any token, how often an id occurs in a range, and where it occurs.

Documents are put in order of doc_id over range partitions; a task encodes its part and closes a
shard after SHARD_TOKENS ids (a longer document has a shard of its own). A shard file is the
``content`` of one row, written by Spark to the shared folder, so a lost task is simply run again.

Defined cases: a missing or empty text has only the end id; a missing doc_id comes first; rows with
an equal doc_id stand in order of a hash of their text; other columns are ignored; an empty table
gives no shards and no rows.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from tidemark.llm.chunks import pieces, text_bytes
from tidemark.llm.common import stored

END_ID = 2
SHARD_TOKENS = 1 << 20
BLOCK_BITS = 512
ENCODE_BYTES = 4 << 20  # of text encoded at once
HELD_WORDS = 1_000_000  # distinct words whose ids a worker remembers
RUN_WORDS = 1000  # unknown words encoded as one text
RUNS = 8  # texts given to a library at once: it makes many times their size
MAGIC = b"TMWM1"

LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
OTHER = (np.arange(256) < 128) & ~LETTER & ~np.isin(np.arange(256), np.arange(48, 58))


def _narrowest(bits: int) -> type:
    return np.uint16 if bits <= 16 else np.uint32


@dataclass(frozen=True)
class WaveletMatrix:
    """``planes`` are packed bits, highest first; ``zeros`` their counts of 0; ``ranks`` ones before each block."""

    size: int
    planes: list[np.ndarray]
    zeros: list[int]
    ranks: list[np.ndarray]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(np.max(ids, initial=0)).bit_length())
        ids = np.asarray(ids, _narrowest(bits))
        planes, zeros, ranks = [], [], []
        for bit in reversed(range(bits)):
            ones = (ids & ids.dtype.type(1 << bit)) != 0
            plane = np.zeros(-(-len(ids) // BLOCK_BITS) * (BLOCK_BITS // 8), np.uint8)
            plane[: -(-len(ids) // 8)] = np.packbits(ones, bitorder="little")
            in_block = np.bitwise_count(plane.view(np.uint64)).reshape(-1, BLOCK_BITS // 64).sum(axis=1)
            planes.append(plane)
            ranks.append(np.concatenate(([0], np.cumsum(in_block))).astype(np.uint32))
            zeros.append(int(len(ids) - ranks[-1][-1]))
            ids = np.concatenate((np.compress(~ones, ids), np.compress(ones, ids)))
        return cls(len(ids), planes, zeros, ranks)

    # A file: magic, ids, planes, then per plane its zeros, the compressed sizes, rank counts and bits.
    def to_bytes(self) -> bytes:
        pack = zstandard.ZstdCompressor(level=3)
        out = [MAGIC, struct.pack("<QI", self.size, len(self.planes))]
        for plane, zeros, ranks in zip(self.planes, self.zeros, self.ranks):
            counts, bits = pack.compress(ranks.tobytes()), pack.compress(plane.tobytes())
            out += [struct.pack("<QII", zeros, len(counts), len(bits)), counts, bits]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, content: bytes) -> WaveletMatrix:
        if content[: len(MAGIC)] != MAGIC:
            raise ValueError("not a shard file")
        unpack, at = zstandard.ZstdDecompressor(), len(MAGIC)
        size, number = struct.unpack_from("<QI", content, at)
        at += struct.calcsize("<QI")
        planes, zeros, ranks = [], [], []
        for _ in range(number):
            z, n_counts, n_bits = struct.unpack_from("<QII", content, at)
            at += struct.calcsize("<QII")
            zeros.append(z)
            ranks.append(np.frombuffer(unpack.decompress(content[at : at + n_counts]), np.uint32))
            planes.append(np.frombuffer(unpack.decompress(content[at + n_counts : at + n_counts + n_bits]), np.uint8))
            at += n_counts + n_bits
        return cls(size, planes, zeros, ranks)

    def _bits(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[level][at >> 3] >> (at & 7).astype(np.uint8)) & 1

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block = at // BLOCK_BITS
        inside = np.concatenate((self.planes[level], np.zeros(BLOCK_BITS // 8, np.uint8))).reshape(-1, BLOCK_BITS // 8)[block]
        before = np.arange(BLOCK_BITS) < (at % BLOCK_BITS)[:, None]
        ones = np.unpackbits(inside, axis=1, bitorder="little") * before
        return self.ranks[level][block].astype(np.int64) + ones.sum(axis=1, dtype=np.int64)

    def _select(self, level: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Places of the k-th (from 0) ones or zeros."""
        before = self.ranks[level].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK_BITS - before
        block = np.searchsorted(before, k, side="right") - 1
        inside = np.unpackbits(self.planes[level].reshape(-1, BLOCK_BITS // 8)[block], axis=1, bitorder="little")
        nth = np.cumsum(inside == bit, axis=1) > (k - before[block])[:, None]
        return block * BLOCK_BITS + np.argmax(nth, axis=1)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at the given places."""
        at, value = np.asarray(at, np.int64), np.zeros(len(at), np.uint32)
        for level, zeros in enumerate(self.zeros):
            bit, ones = self._bits(level, at), self._rank(level, at)
            value = (value << np.uint32(1)) | bit
            at = np.where(bit == 1, zeros + ones, at - ones)
        return value

    def _range(self, value: int, begin: int, end: int) -> tuple[int, int]:
        """Where the value's occurrences in begin .. end - 1 stand after the last plane."""
        if value >> len(self.planes):
            return 0, 0
        for level, zeros in enumerate(self.zeros):
            ones = self._rank(level, np.array([begin, end])).tolist()
            if value >> (len(self.planes) - 1 - level) & 1:
                begin, end = zeros + ones[0], zeros + ones[1]
            else:
                begin, end = begin - ones[0], end - ones[1]
        return begin, end

    def count(self, value: int, begin: int = 0, end: int | None = None) -> int:
        first, last = self._range(value, begin, self.size if end is None else end)
        return last - first

    def positions(self, value: int, begin: int = 0, end: int | None = None) -> np.ndarray:
        """All places of an id in a range, in order."""
        at = np.arange(*self._range(value, begin, self.size if end is None else end))
        for level in reversed(range(len(self.planes))):
            bit = value >> (len(self.planes) - 1 - level) & 1
            at = self._select(level, bit, at - self.zeros[level] if bit else at)
        return at

    def decode(self) -> np.ndarray:
        """All ids: from the last plane up, each plane's partition undone."""
        value = np.zeros(self.size, _narrowest(len(self.planes)))
        for shift, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            ones = np.unpackbits(plane, count=self.size, bitorder="little").view(bool)
            above = np.empty_like(value)
            above[np.flatnonzero(~ones)] = value[:zeros]
            above[np.flatnonzero(ones)] = value[zeros:] | value.dtype.type(1 << shift)
            value = above
        return value.astype(np.uint32)


# --- on DataFrames ------------------------------------------------------------------------------

SHARDS = "part int, shard int, n_documents bigint, n_tokens bigint, lengths array<bigint>, content binary"


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where a piece of text may be cut off without changing its ids, besides at every text's begin.

    The vocabulary's pattern never matches across a single space between two characters that are no
    white space, and takes the space with what follows; nor across a letter before an ASCII mark.
    Characters outside ASCII count only where their first byte rules out white space.
    """
    cut = np.zeros(len(data), bool)
    plain = (data > 32) & (data < 127)
    lead = (data >= 0xC3) & (data < 0xE0)
    if len(data) > 2:
        ends = plain.copy()
        ends[1:] |= lead[:-1]  # the second of two bytes
        cut[1:-1] = (data[1:-1] == 32) & ends[:-2] & (plain | lead)[2:]
    begins = offsets[:-1][np.diff(offsets) > 0]
    cut[begins] = True
    after = begins + 1
    after = after[after < len(data)]
    cut[after] &= np.isin(after, begins)  # the character before is another text's or unknown
    cut[1:] |= LETTER[data[:-1]] & OTHER[data[1:]]
    return np.flatnonzero(cut)


class WordIds:
    """The ids of words, each distinct one encoded once as long as a memory of up to ``held`` words lasts.

    ``encode`` gives (where each word's ids begin, how many they are, all ids) of an Arrow array of words.
    """

    def __init__(
        self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]], held: int, kind: type
    ) -> None:
        self.encode, self.held, self.kind = encode, held, kind
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.sizes, self.begins, self.flat = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, self.kind)

    def places(self, words: pa.Array) -> np.ndarray:
        """Where distinct words stand in ``sizes`` and ``begins``; unknown ones are encoded.

        The known words are one Arrow array, hashed anew for every call: a dict of strings takes ten times its memory.
        """
        if len(self.known) > self.held:
            self._forget()
        at = pc.index_in(words, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            unknown = words.take(pa.array(new))
            begins, sizes, flat = self.encode(unknown)
            at[new] = np.arange(len(self.sizes), len(self.sizes) + len(new))
            self.known = pa.concat_arrays([self.known, unknown])
            self.sizes = np.concatenate((self.sizes, sizes.astype(np.int32)))
            self.begins = np.concatenate((self.begins, len(self.flat) + begins))
            self.flat = np.concatenate((self.flat, flat.astype(self.kind)))
        return at

    def of(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words that begin at these places of the bytes, offsets between the words)."""
        which = np.empty(0, np.int64)
        if len(begins):
            bounds = pa.py_buffer(np.append(begins, len(data)).astype(np.int64))
            words = pa.Array.from_buffers(
                pa.large_string(), len(begins), [None, bounds, pa.py_buffer(np.ascontiguousarray(data))])
            coded = words.dictionary_encode()
            which = self.places(coded.dictionary)[coded.indices.to_numpy()]
        lengths = self.sizes[which]
        ends = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
        at = np.repeat(self.begins[which] - ends[:-1], lengths)
        at += np.arange(ends[-1])
        return self.flat[at], ends


def listed(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(lengths of the lists, the lists one after the other)."""
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return sizes, np.fromiter(chain.from_iterable(found), np.uint32, sizes.sum())


def listed_by(encode: Callable[[list[str]], list[list[int]]], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``listed`` of a library's ids of the texts, which gets a few of them at a time."""
    found = [listed(encode(texts[i : i + RUNS])) for i in range(0, max(1, len(texts)), RUNS)]
    return tuple(np.concatenate(x) for x in zip(*found))


def in_runs(
    words: pa.Array,
    joined: np.ndarray,
    library: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
    bytes_of: np.ndarray,
    unfit: Callable[[list[str]], np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' ids in the form of ``WordIds``, from ``library``'s ids of runs of words, each one text.

    A word that is ``joined`` may follow the one before in a run. A run is taken apart where a token ends with every
    word; the words of one where that fails, or that is ``unfit``, are encoded one by one.
    """
    data, offsets = text_bytes(words)
    follows = joined.copy()
    follows[::RUN_WORDS] = False
    first, run = np.flatnonzero(~follows), np.cumsum(~follows) - 1
    begin, end = offsets[first], np.append(offsets[first[1:]], len(data))
    raw = data.tobytes()
    runs = [raw[b:e].decode() for b, e in zip(begin.tolist(), end.tolist())]
    sizes, ids = library(runs)
    each = bytes_of[ids]
    upto = np.concatenate(([0], np.cumsum(np.where(each > 0, each, len(data) + 1))))  # a token of no bytes fits nowhere
    tokens = upto[np.concatenate(([0], np.cumsum(sizes)))]
    bad = np.diff(tokens) != end - begin
    if unfit is not None:
        bad |= unfit(runs) & (np.diff(np.append(first, len(words))) > 1)
    shift = (tokens[:-1] - begin)[run]
    at, last = (np.searchsorted(upto, o + shift) for o in (offsets[:-1], offsets[1:]))
    bad[run[upto[np.minimum(last, len(ids))] != offsets[1:] + shift]] = True
    alone = np.flatnonzero(bad[run])
    if len(alone):
        sizes, more = library(words.take(pa.array(alone)).to_pylist())
        last[alone] = len(ids) + np.cumsum(sizes)
        at[alone] = last[alone] - sizes
        ids = np.concatenate((ids, more))
    return at, last - at, ids


def entry_bytes(tokenizer: Tokenizer) -> np.ndarray:
    """How many bytes every id of a byte-level vocabulary stands for: each character of its name is one."""
    entries = tokenizer.get_vocab()
    sizes = np.zeros(max(entries.values()) + 1, np.int64)
    sizes[list(entries.values())] = [len(name) for name in entries]
    return sizes


class WordEncoder:
    """Encodes every distinct word once, as long as its memory of up to ``held`` words lasts.

    The ids are those the tokenizers library gives for the whole text: a text that has the name of
    an added token in it is not cut into words. Unknown words go to the library as one text of
    many words, where they may be cut off from each other; the bytes of the ids tell whose they are.
    """

    def __init__(self, tokenizer: Tokenizer, held: int = HELD_WORDS) -> None:
        self.tokenizer, self.bytes_of = tokenizer, entry_bytes(tokenizer)
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.words = WordIds(self._encoded, held, np.uint32)

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return listed_by(lambda some: [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)], texts)

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, offsets = text_bytes(words)
        cut = np.zeros(len(data) + 1, bool)
        cut[word_starts(data, np.array([0, len(data)]))] = True
        named = self._named(words)
        joined = cut[offsets[:-1]] & ~named
        joined[1:] &= ~named[:-1]

        def together(runs: list[str]) -> np.ndarray:
            """Words that only together have the name of an added token are no run."""
            return self._named(pa.array(runs, pa.large_string()))

        return in_runs(words, joined, self._library, self.bytes_of, together)

    def _named(self, texts: pa.Array) -> np.ndarray:
        """Whether each text has the name of an added token in it."""
        named = np.zeros(len(texts), bool)
        for name in self.added:
            named |= pc.match_substring(texts, name).fill_null(False).to_numpy(zero_copy_only=False)
        return named

    def _whole(self, column: pa.Array, offsets: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The begins without those inside texts that name an added token."""
        named = self._named(column)
        if not named.any():
            return begins
        text = np.searchsorted(offsets, begins, side="right") - 1
        return begins[~named[text] | (begins == offsets[text])]

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id, offsets between the texts)."""
        data, offsets = text_bytes(column)
        begins = self._whole(column, offsets, word_starts(data, offsets))
        ids, ends = self.words.of(data, begins)
        ends = ends[np.searchsorted(begins, offsets)]
        return np.insert(ids, ends[1:], END_ID), ends + np.arange(len(offsets))


@cache
def _encoder(tokenizer_file: str) -> WordEncoder:
    """One for all tasks of a Python worker: the words it remembers serve the next task too."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return WordEncoder(Tokenizer.from_file(tokenizer_file))


def _shard_batches(
    batches: Iterator[pa.RecordBatch], tokenizer_file: str, tokens: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(tokenizer_file)
    part, shard = TaskContext.get().partitionId(), 0
    ids, keys, size = [], [], 0

    def closed() -> pa.RecordBatch:
        content = WaveletMatrix.build(np.concatenate(ids)).to_bytes()
        lengths = [len(x) for x in ids]
        values = [part, shard, len(ids), size, lengths, pa.concat_arrays(keys).to_pylist(), content]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    for batch in pieces(batches, limit=ENCODE_BYTES):
        every, offsets = encoder.texts(batch.column("text"))
        for i, found in enumerate(np.split(every, offsets[1:-1])):
            if ids and size + len(found) > tokens:
                yield closed()
                ids, keys, size, shard = [], [], 0, shard + 1
            ids.append(found)
            keys.append(batch.column("doc_id").slice(i, 1))
            size += len(found)
    if ids:
        yield closed()


def write_shards(docs: DataFrame, tokenizer_file: str, tokens: int = SHARD_TOKENS, partitions: int | None = None) -> DataFrame:
    """The stored shards, a row each: their place in the order, their documents, and the shard file.

    ``part`` and ``shard`` give the order. ``doc_ids`` and ``lengths`` are the documents, in order.
    """
    spark = docs.sparkSession
    number = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = SHARDS.replace("content", f"doc_ids array<{kind}>, content")
    schema = to_arrow_schema(spark.createDataFrame([], names).schema)
    place = [F.col("doc_id").asc_nulls_first(), F.col("place")]
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("place"))
        .repartitionByRange(number, *place).sortWithinPartitions(*place, F.col("text"))
    )
    return stored(
        ordered.select("doc_id", "text").mapInArrow(
            lambda batches: _shard_batches(batches, tokenizer_file, tokens, schema), names),
        "token-shards",
    )


def read_shards(shards: DataFrame) -> DataFrame:
    """(part, shard, doc_id, before, n_tokens, ids_crc32): the documents of each shard file, decoded.

    ``before`` counts the ids that precede a document in its shard.
    """
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, shard, lengths, content = (batch.column(c)[i].as_py() for c in ("part", "shard", "lengths", "content"))
                raw = WaveletMatrix.from_bytes(content).decode().astype("<u4").tobytes()
                sizes = np.array(lengths, np.int64)
                before = np.cumsum(sizes) - sizes
                sums = [zlib.crc32(raw[4 * b : 4 * (b + n)]) for b, n in zip(before.tolist(), lengths)]
                fixed = [pa.array(np.full(len(sizes), x, np.int32)) for x in (part, shard)]
                yield pa.RecordBatch.from_arrays(
                    [*fixed, batch.column("doc_ids")[i].values, pa.array(before), pa.array(sizes), pa.array(sums, pa.int64())],
                    ["part", "shard", "doc_id", "before", "n_tokens", "ids_crc32"])

    return shards.select("part", "shard", "doc_ids", "lengths", "content").mapInArrow(
        run, f"part int, shard int, doc_id {kind}, before bigint, n_tokens bigint, ids_crc32 bigint")


def shard_offsets(shards: DataFrame) -> DataFrame:
    """(part, shard, offset): ids in all earlier shards.

    Shards are summed inside their range partition; only one row per range partition, however long
    the input, meets in one window.
    """
    sizes = shards.select("part", "shard", "n_tokens")
    earlier = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens")).select(
        "part", earlier(W.orderBy("part")).alias("base"))
    inside = sizes.select("part", "shard", earlier(W.partitionBy("part").orderBy("shard")).alias("inside"))
    return inside.join(parts, "part").select("part", "shard", (F.col("base") + F.col("inside")).alias("offset"))


def token_output(docs: DataFrame, tokenizer_file: str, tokens: int = SHARD_TOKENS) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, part, shard) of every document, from the files written."""
    shards = write_shards(docs, tokenizer_file, tokens)
    return read_shards(shards).join(shard_offsets(shards), ["part", "shard"]).select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "part", "shard")
