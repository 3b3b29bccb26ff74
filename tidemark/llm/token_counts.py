"""Token counts by a linear longest-match automaton.

A word is written with a space before it and cut greedily: the longest vocabulary piece first, then
the longest continuing it. The automaton is the vocabulary's trie with failure links: a node that
cannot go on hands over to the node of the rest of its string, after the pieces it is sure of are
popped. Only their number is kept, so no piece is ever built, and a text costs time in proportion
to its bytes. All words of a batch advance together, one byte a step.

Words are runs of other than ASCII white space. The vocabulary must hold every single byte.

Defined cases: a missing or empty text has no words and no tokens; repeated rows are counted each
for itself; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.chunks import pieces, text_bytes

SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
PACKED = 8  # words of at most so many bytes are counted once per batch


def read_vocabulary(path: str) -> list[bytes]:
    """The pieces of a file of base64 strings and ranks."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


@dataclass(frozen=True)
class Automaton:
    """``edges`` are node * 256 + byte in order, ``child`` where they lead; node 0 is the root."""

    edges: np.ndarray
    child: np.ndarray
    fail: np.ndarray
    popped: np.ndarray  # pieces popped on the way along the failure link
    rest: np.ndarray  # pieces popped if the word ends here

    def next_nodes(self, nodes: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Where each node goes with a byte, or -1."""
        key = nodes * 256 + byte
        at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
        return np.where(self.edges[at] == key, self.child[at], -1)


def build_automaton(vocabulary: Iterable[bytes]) -> Automaton:
    goto: dict[int, int] = {}
    token, parent, label = [False], [0], [0]
    for piece in vocabulary:
        node = 0
        for byte in piece:
            key = node * 256 + byte
            node = goto.get(key, -1)
            if node < 0:
                node = goto[key] = len(token)
                token.append(False)
                parent.append(key >> 8)
                label.append(byte)
        if piece:
            token[node] = True
    lacking = [b for b in range(256) if b not in goto or not token[goto[b]]]
    if lacking:
        raise ValueError(f"the vocabulary lacks {len(lacking)} single bytes, {lacking[0]:#04x} first")
    n = len(token)
    fail, popped, rest = [-1] * n, [0] * n, [0] * n
    depth = [0] * n
    for node in range(1, n):  # a parent is older than its children
        depth[node] = depth[parent[node]] + 1
    for node in sorted(range(1, n), key=depth.__getitem__):
        if token[node]:
            fail[node], popped[node] = 0, 1
        else:
            up, byte = parent[node], label[node]
            count, other = popped[up], fail[up]
            while other * 256 + byte not in goto:
                count += popped[other]
                other = fail[other]
            fail[node], popped[node] = goto[other * 256 + byte], count
        rest[node] = popped[node] + rest[fail[node]]
    keys = np.fromiter(goto, np.int64, len(goto))
    order = np.argsort(keys)
    child = np.fromiter(goto.values(), np.int32, len(goto))[order]
    return Automaton(keys[order], child, *(np.array(x, np.int32) for x in (fail, popped, rest)))


def _advance(automaton: Automaton, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Pieces of each word, given where its bytes are."""
    order = np.argsort(-lengths, kind="stable")
    begins, sizes = begins[order], lengths[order]
    first = int(automaton.next_nodes(np.zeros(1, np.int64), np.full(1, 32))[0])
    node, count = np.full(len(begins), first, np.int64), np.zeros(len(begins), np.int64)
    for step in range(int(sizes.max(initial=0))):
        active = int(np.searchsorted(-sizes, -step, side="left"))
        at, byte = node[:active], data[begins[:active] + step].astype(np.int64)
        to = automaton.next_nodes(at, byte)
        stuck = np.flatnonzero(to < 0)
        while len(stuck):
            here = at[stuck]
            count[stuck] += automaton.popped[here]
            at[stuck] = automaton.fail[here]
            to[stuck] = automaton.next_nodes(at[stuck], byte[stuck])
            stuck = stuck[to[stuck] < 0]
        node[:active] = to
    out = np.empty(len(begins), np.int64)
    out[order] = count + automaton.rest[node]
    return out


def count_tokens(automaton: Automaton, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, tokens) of each text."""
    texts = len(offsets) - 1
    word = ~SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1] | cut[1:-1]
    end[:-1] &= ~word[1:] | cut[1:-1]
    begins = np.flatnonzero(start)
    lengths = np.flatnonzero(end) + 1 - begins
    tokens = np.zeros(len(begins), np.int64)
    short = np.flatnonzero(lengths <= PACKED)
    packed = np.zeros(len(short), np.uint64)
    for step in range(PACKED):
        on = lengths[short] > step
        packed[on] |= data[begins[short[on]] + step].astype(np.uint64) << np.uint64(8 * step)
    # A zero byte at a word's end is told apart by the length.
    _, sample, inverse = np.unique(packed, return_index=True, return_inverse=True)
    plain = lengths[short] == lengths[short][sample][inverse] if len(short) else np.empty(0, bool)
    each = _advance(automaton, data, begins[short[sample]], lengths[short[sample]])
    tokens[short[plain]] = each[inverse[plain]]
    other = np.concatenate((np.flatnonzero(lengths > PACKED), short[~plain]))
    tokens[other] = _advance(automaton, data, begins[other], lengths[other])
    text = np.searchsorted(offsets, begins, side="right") - 1
    total = np.bincount(text, weights=tokens, minlength=texts).astype(np.int64)
    return np.bincount(text, minlength=texts), total


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_bytes, n_words, n_tokens): one row per document. ``vocabulary`` is a file's path."""
    automaton = build_automaton(read_vocabulary(vocabulary))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets = text_bytes(batch.column("text"))
            columns = [np.diff(offsets), *count_tokens(automaton, data, offsets)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                ["doc_id", "n_bytes", "n_words", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        counted, f"doc_id {kind}, n_bytes bigint, n_words bigint, n_tokens bigint")
