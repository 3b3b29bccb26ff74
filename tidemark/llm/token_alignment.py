"""Two tokenizers over the same bytes: which of their tokens overlap, and where both end.

The bytes are a space and the text. Each tokenization is an incidence matrix, tokens by bytes, in
compressed rows built by hand: a token's columns are the bytes it covers. Gustavson's row products
A * B^T run through the bytes of each A token, take the B tokens of each byte and add up equal
columns: what is left are the overlap links, with the bytes shared as values. Places where both
tokenizations end a token cut the bytes into groups; tokens by groups are two more incidence
matrices, and a row of their product is the group's row of B tokens, so the links between all tokens
that share a group need not be written out to be counted.

The encodings of a few megabytes of text make up a block and are stored, compressed. How often an id
pair is linked in the corpus is counted per block first; the total counts of a block's own pairs
then meet its encodings again, so no task holds a table of all pairs.

Defined cases: a missing or empty text, and one whose tokens' joined bytes are not the space and the
text (one with U+2581, say), has no tokens and all figures zero; repeated rows count each for
itself; a missing doc_id stays; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from tidemark.functions.joins import lookup_join
from tidemark.llm.chunks import pieces, text_bytes
from tidemark.llm.common import stored
from tidemark.llm.wavelet_output import WordEncoder, WordIds, in_runs, listed_by

BLOCK_BYTES = 2 << 20  # of text in a block; a longer text is a block of its own
SLICE_BYTES = 1 << 18  # bytes whose row products are formed at once
MARK = "\u2581"  # a space, in the names of pieces
HELD_WORDS = 300_000  # distinct words whose ids a worker remembers, of each tokenizer


# --- sparse matrices ----------------------------------------------------------------------------


def gathered(values: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices values[b : b + n], one after the other; place numbers are made for a part of them at a time."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    out = np.empty(total, values.dtype)
    first, at = 0, 0
    for last in [*np.searchsorted(ends, np.arange(SLICE_BYTES, total, SLICE_BYTES)).tolist(), len(ends)]:
        if last > first:
            n = lengths[first:last]
            here = int(ends[last - 1])
            out[at:here] = values[np.arange(at, here) + np.repeat(begins[first:last] - ends[first:last] + n, n)]
            first, at = last, here
    return out


@dataclass(frozen=True)
class Rows:
    """A matrix in compressed rows: the columns of row i are indices[starts[i] : starts[i + 1]]."""

    starts: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    columns: int

    @classmethod
    def covering(cls, lengths: np.ndarray) -> Rows:
        """Tokens by bytes: each row covers the next ``lengths[i]`` columns."""
        starts = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
        return cls(starts, np.arange(starts[-1]), np.ones(starts[-1], np.int32), int(starts[-1]))

    @classmethod
    def members(cls, group: np.ndarray, groups: int) -> Rows:
        """Tokens by groups: each row has one entry."""
        return cls(np.arange(len(group) + 1), group, np.ones(len(group), np.int32), groups)

    def part(self, first: int, last: int) -> Rows:
        begin, end = self.starts[first], self.starts[last]
        return Rows(self.starts[first : last + 1] - begin, self.indices[begin:end], self.values[begin:end], self.columns)

    def transposed(self) -> Rows:
        row, values = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts)), self.values
        if (self.indices[1:] < self.indices[:-1]).any():
            order = np.argsort(self.indices, kind="stable")
            row, values = row[order], values[order]
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.indices, minlength=self.columns))))
        return Rows(starts, row, values, len(self.starts) - 1)

    def times(self, other: Rows) -> Rows:
        """Gustavson's product: row by row, the other's rows at this row's columns, equal columns added up."""
        begins, lengths = other.starts[self.indices], np.diff(other.starts)[self.indices]
        row = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        if (lengths == 1).all():  # every row met has one entry, as the row of a byte has
            column, value = other.indices[begins], self.values * other.values[begins]
        else:
            column = gathered(other.indices, begins, lengths)
            value = np.repeat(self.values, lengths) * gathered(other.values, begins, lengths)
            row = np.repeat(row, lengths)
        key = row * other.columns + column
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))
        value = np.add.reduceat(value, first) if len(first) else value
        row, column = key[first] // other.columns, key[first] % other.columns
        starts = np.searchsorted(row, np.arange(len(self.starts)))
        return Rows(starts, column, value, other.columns)

    def product_sizes(self, other: Rows) -> np.ndarray:
        """Entries of each row of the product where no row of this matrix has two."""
        return np.diff(other.starts)[self.indices]


# --- one block ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Block:
    """The tokens of some texts: ids one after the other, how many each text has, and their sizes in bytes."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    a_sizes: np.ndarray
    b_sizes: np.ndarray


def overlap_links(block: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(A tokens, B tokens, bytes shared) of the links, by place in the block, a slice of A rows at a time."""
    a, bytes_b = Rows.covering(block.a_sizes), Rows.covering(block.b_sizes).transposed()
    cuts = np.searchsorted(a.starts, np.arange(SLICE_BYTES, max(a.columns, 1), SLICE_BYTES))
    bounds = np.unique(np.concatenate(([0], cuts, [len(block.a)])))
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        links = a.part(first, last).times(bytes_b)
        yield np.repeat(np.arange(first, last), np.diff(links.starts)), links.indices, links.values


def groups(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group of each A token, group of each B token, the byte each group ends at)."""
    a_ends, b_ends = np.cumsum(block.a_sizes), np.cumsum(block.b_sizes)
    ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
    return np.searchsorted(ends, a_ends), np.searchsorted(ends, b_ends), ends


def shared_group_links(block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(A tokens, B tokens) of one group, a slice of A rows at a time."""
    in_a, in_b, ends = groups(block)
    a, b = Rows.members(in_a, len(ends)), Rows.members(in_b, len(ends)).transposed()
    heavy = np.cumsum(a.product_sizes(b))
    cuts = np.searchsorted(heavy, np.arange(SLICE_BYTES, max(int(heavy[-1]) if len(heavy) else 0, 1), SLICE_BYTES))
    bounds = np.unique(np.concatenate(([0], cuts, [len(block.a)])))
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        links = a.part(first, last).times(b)
        yield np.repeat(np.arange(first, last), np.diff(links.starts)), links.indices


@cache
def _decimals(bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All numbers of so many bits in decimals, a space after each: the bytes, where each begins, and its length."""
    texts = [b"%d " % n for n in range(1 << bits)]
    sizes = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes


def group_texts(block: Block) -> list[bytes]:
    """Of each text its groups as ``a1,a2|b1;a3|b2,b3``."""
    in_a, in_b, ends = groups(block)
    number = len(ends)
    a_upto, b_upto = (np.cumsum(np.bincount(g, minlength=number)) for g in (in_a, in_b))
    a_at = np.arange(len(block.a)) + (b_upto - np.bincount(in_b, minlength=number))[in_a]
    b_at = np.arange(len(block.b)) + a_upto[in_b]
    tokens = np.empty(len(block.a) + len(block.b), np.int64)
    tokens[a_at], tokens[b_at] = block.a, block.b
    mark = np.full(len(tokens), ord(","), np.uint8)
    mark[a_at[a_upto - 1]], mark[b_at[b_upto - 1]] = ord("|"), ord(";")
    raw, begins, sizes = _decimals(int(tokens.max(initial=0)).bit_length())
    lengths = sizes[tokens]
    out = gathered(raw, begins[tokens], lengths)
    ends_at = np.cumsum(lengths)
    out[ends_at - 1] = mark
    cut = np.concatenate(([0], ends_at))[np.concatenate(([0], np.cumsum(block.n_a + block.n_b)))].tolist()
    data = out.tobytes()
    return [data[i : max(i, j - 1)] for i, j in zip(cut, cut[1:])]


def _per_text(amounts: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    total = np.zeros(texts, np.int64)
    np.add.at(total, owner, amounts)
    return total


# --- encodings ----------------------------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest in order from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [i for i in range(256) if i not in own]
    return {**{chr(i): i for i in own}, **{chr(256 + n): i for n, i in enumerate(rest)}}


def byte_entries(tokenizer: Tokenizer) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary."""
    alphabet = byte_alphabet()
    entries = json.loads(tokenizer.to_str())["model"]["vocab"]
    raw = [b""] * (max(entries.values()) + 1)
    for name, i in entries.items():
        raw[i] = bytes(alphabet[c] for c in name) if all(c in alphabet for c in name) else name.encode()
    return raw


def piece_entries(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes of every piece."""
    raw = []
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            raw.append(b"")
        else:
            raw.append(bytes([int(name[1:-1], 16)]) if model.is_byte(i) else name.replace(MARK, " ").encode())
    return raw


def entry_sizes(byte_file: str, piece_file: str) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes every id stands for, in both vocabularies."""
    entries = byte_entries(Tokenizer.from_file(byte_file)), piece_entries(sentencepiece.SentencePieceProcessor(model_file=piece_file))
    return tuple(np.array([len(r) for r in raw], np.int32) for raw in entries)


class PieceWords:
    """Encodes every distinct word once: a space and what follows up to the next space after another character.

    No piece has a space after another character, so none lies across two words. A model where that is
    otherwise encodes whole texts.
    """

    def __init__(self, model: sentencepiece.SentencePieceProcessor, entries: list[bytes]) -> None:
        self.model, self.cuts = model, not any(b" " in r.lstrip(b" ") for r in entries)
        self.bytes_of = np.array([len(r) for r in entries], np.int64)
        self.words = WordIds(self._encoded, HELD_WORDS, np.int32)

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        def encoded(some: list[str]) -> list[list[int]]:
            found = self.model.encode([t[1:] for t in some], num_threads=1)  # the model adds the space, but to no empty text
            return [ids if len(t) > 1 else [self.model.piece_to_id(MARK)] for t, ids in zip(some, found)]

        return listed_by(encoded, texts)

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, offsets = text_bytes(words)
        joined = np.full(len(words), self.cuts)
        joined[1:] &= data[offsets[1:-1] - 1] != 32  # what follows a space would be cut off nowhere
        return in_runs(words, joined, self._library, self.bytes_of)

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets between the texts) of texts that are empty or begin with the added space."""
        data, offsets = text_bytes(column)
        cut = np.zeros(len(data) + 1, bool)
        if self.cuts:
            cut[1:-1] = (data[1:] == 32) & (data[:-1] != 32)
        cut[offsets[1:]] = False
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        begins = np.flatnonzero(cut)
        ids, ends = self.words.of(data, begins)
        return ids, ends[np.searchsorted(begins, offsets)]


class Encoders:
    """Both tokenizers, and the bytes of every id."""

    def __init__(self, byte_file: str, piece_file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tokenizer = Tokenizer.from_file(byte_file)
        tokenizer.encode_special_tokens = True
        model = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        entries = byte_entries(tokenizer), piece_entries(model)
        (self.a_raw, self.a_at), (self.b_raw, self.b_at) = (
            (np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))) for raw in entries)
        self.words, self.pieces = WordEncoder(tokenizer, HELD_WORDS), PieceWords(model, entries[1])

    def block(self, column: pa.Array) -> Block:
        """The encodings of a batch's texts, without those that do not give the bytes back."""
        texts = column.to_pylist()
        spaced = pa.array([" " + t if t else "" for t in texts], pa.large_string())
        data, offsets = text_bytes(spaced)
        a, a_offsets = self.words.texts(spaced)
        a = np.delete(a, a_offsets[1:] - 1).astype(np.int64)  # without the end ids
        n_a = np.diff(a_offsets) - 1
        b, b_offsets = self.pieces.texts(spaced)
        b, n_b = b.astype(np.int64), np.diff(b_offsets)
        same = np.diff(offsets) > 0
        for ids, n, raw, at in ((a, n_a, self.a_raw, self.a_at), (b, n_b, self.b_raw, self.b_at)):
            sizes = np.diff(at)[ids]
            ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(n)))]
            same &= np.diff(ends) == np.diff(offsets)
            joined = gathered(raw, at[ids], sizes)
            begins, lengths = ends[:-1][same], np.diff(ends)[same]
            differs = gathered(joined, begins, lengths) != gathered(data, offsets[:-1][same], lengths)
            wrong = np.concatenate(([0], np.cumsum(differs)))[np.concatenate(([0], np.cumsum(lengths)))]
            same[np.flatnonzero(same)[np.diff(wrong) > 0]] = False
        a, b = a[np.repeat(same, n_a)], b[np.repeat(same, n_b)]
        return Block(a, b, np.where(same, n_a, 0), np.where(same, n_b, 0), np.diff(self.a_at)[a], np.diff(self.b_at)[b])


@cache
def _encoders(byte_file: str, piece_file: str) -> Encoders:
    """One for all tasks of a Python worker: the words it remembers serve the next task too. Later stages drop it."""
    return Encoders(byte_file, piece_file)


def _forget_encoders() -> None:
    _encoders.cache_clear()
    pa.default_memory_pool().release_unused()


# --- on DataFrames ------------------------------------------------------------------------------


def _packed(values: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(values.astype(kind).tobytes())


def encodings(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """The stored blocks, a row each: its documents and their tokens in both tokenizations, compressed."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = (
        f"block bigint, doc_ids array<{kind}>, n_a array<int>, n_b array<int>, a binary, b binary")
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], names).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders, number = _encoders(byte_file, piece_file), TaskContext.get().partitionId() << 32
        for batch in pieces(batches, limit=BLOCK_BYTES):
            block = encoders.block(batch.column("text"))
            row = [number, batch.column("doc_id").to_pylist(), block.n_a.tolist(), block.n_b.tolist(),
                   _packed(block.a, "<u4" if block.a.max(initial=0) >> 16 else "<u2"),
                   _packed(block.b, "<u4" if block.b.max(initial=0) >> 16 else "<u2")]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)
            number += 1
            del block, row
            pa.default_memory_pool().release_unused()

    return stored(docs.select("doc_id", "text").mapInArrow(run, names), "alignment-blocks")


def _read(row: dict, sizes: tuple[np.ndarray, np.ndarray]) -> Block:
    n_a, n_b = np.array(row["n_a"], np.int64), np.array(row["n_b"], np.int64)
    ids = []
    for data, n in ((row["a"], n_a), (row["b"], n_b)):
        raw = zstandard.ZstdDecompressor().decompress(data)
        ids.append(np.frombuffer(raw, "<u2" if len(raw) == 2 * n.sum() else "<u4").astype(np.int64))
    return Block(*ids, n_a, n_b, *(size[i].astype(np.int64) for size, i in zip(sizes, ids)))


def _pairs(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct id pair of the block's links, as a << 32 | b, and how many links hold it."""
    found = [pa.array(block.a[i] << 32 | block.b[j]).value_counts() for i, j, _ in overlap_links(block)]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs, which = np.unique(np.concatenate([f.field(0).to_numpy() for f in found]), return_inverse=True)
    return pairs, _per_text(np.concatenate([f.field(1).to_numpy() for f in found]), which, len(pairs))


def aligned_documents(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """One row per document: its tokens, groups and links, and how usual its links are in the corpus.

    doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_group_links. An id pair's
    count is the number of links that hold it in all documents; ``n_best`` are the links whose
    count is the highest of their B id, ``count_sum`` adds up the counts of all links.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks, sizes = encodings(docs, byte_file, piece_file), entry_sizes(byte_file, piece_file)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget_encoders()
        for batch in batches:
            for row in batch.to_pylist():
                pairs, n = _pairs(_read(row, sizes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), row["block"])), pa.array(pairs), pa.array(n)], ["block", "pair", "n"])

    counted = stored(
        blocks.mapInArrow(count, "block bigint, pair bigint, n bigint"), "alignment-pairs")
    totals = counted.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1))
    totals = stored(totals, "alignment-totals")
    most = totals.groupBy("b").agg(F.max("total").alias("most"))  # a row per id of the vocabulary
    judged = lookup_join(totals, most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    own = counted.join(judged, "pair").select("block", "pair", "total", "best")

    names = (
        f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
        "groups_sha256 string, n_group_links bigint")
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], names).schema)

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        _forget_encoders()
        order = np.argsort(right.column("pair").to_numpy())
        pairs, total = (right.column(c).to_numpy()[order] for c in ("pair", "total"))
        best = right.column("best").to_numpy()[order].astype(np.int64)
        out = []
        for row in left.to_pylist():
            block = _read(row, sizes)
            texts = len(block.n_a)
            of_a = np.repeat(np.arange(texts), block.n_a)
            n_links, n_best, count_sum = (np.zeros(texts, np.int64) for _ in range(3))
            for i, j, _ in overlap_links(block):
                coded = pa.array(block.a[i] << 32 | block.b[j]).dictionary_encode()
                at = np.searchsorted(pairs, coded.dictionary.to_numpy())[coded.indices.to_numpy()]
                # Links stand in order of their text: its sums are differences of running ones.
                bounds = np.searchsorted(of_a[i], np.arange(texts + 1))
                n_links += np.diff(bounds)
                for sums, amounts in ((n_best, best), (count_sum, total)):
                    sums += np.diff(np.concatenate(([0], np.cumsum(amounts[at])))[bounds])
            in_a, in_b, ends = groups(block)
            a, b = Rows.members(in_a, len(ends)), Rows.members(in_b, len(ends)).transposed()
            group_links = _per_text(a.product_sizes(b), of_a, texts)
            n_groups = np.zeros(texts, np.int64)
            some = np.flatnonzero(block.n_a)
            last = in_a[np.cumsum(block.n_a)[some] - 1] + 1 if len(some) else np.empty(0, np.int64)
            n_groups[some] = np.diff(np.concatenate(([0], last)))
            digests = [hashlib.sha256(t).hexdigest() if t else "" for t in group_texts(block)] if len(some) else [""] * texts
            columns = [row["doc_ids"], block.n_a, block.n_b, n_groups, n_links, n_best, count_sum, digests, group_links]
            out.append(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return blocks.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(judge, names)
