"""SentencePiece encoding by a batched Viterbi search, and decoding.

A text is normalised as the model asks (a leading space, spaces as U+2581) and cut where no piece
can lie across: before a space mark that follows another character, and around characters in no
piece. Of the words of a batch each distinct one is encoded once. Words of equal length are rows of
one matrix and advance together; the hash of a substring comes from prefix hashes and is looked up
among the sorted hashes of the pieces. The best score and the length of the piece that gave it are
kept per end; going back along these lengths gives the pieces.

``viterbi`` is for unigram scores: the segmentation with the highest sum (at equal sums the longer
last piece).

``ranked_viterbi`` is for a model file of merges, whose scores are ranks, and gives the library's own
ids. Merging in rank order can end in a row of pieces only if merging the text of each piece gives
that piece, and merging the text of each two neighbours gives these two. Every other step has score
minus infinity. Whether two pieces may follow each other is tested once, by merging their text
(``merges``), and remembered; at every end of a word one admissible piece is left. A word longer than
LONG_WORD advances alone, by the same rule. The queries use it.

``merges`` takes the merges one by one: each word's best-scored neighbours whose join is a piece become
one, the leftmost of equal ones first, a long word's from a heap. It decides the steps and is what
the search is tested against.

Characters without a piece become the byte pieces of their UTF-8 form. Decoding gives back the
text, save that U+2581 in a text comes back as a space.

Defined cases: a missing or empty text has no pieces and decodes to an empty text; repeated rows are
encoded alike; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tidemark.llm.chunks import pieces

MARK = 0x2581
BASE = np.uint64(0x9E3779B97F4A7C15)
TABLE_BITS = 20
UNKNOWN = -1
UNKNOWN_PENALTY = 10.0
CHUNK_BYTES = 8 << 20
LONG_WORD = 48  # characters from which a word advances alone, and its merges are taken from a heap
HELD_STEPS = 4_000_000  # pairs of pieces a task remembers


def _hashes(matrix: np.ndarray) -> np.ndarray:
    """Prefix hashes of each row: column j covers the first j characters."""
    out = np.zeros((matrix.shape[0], matrix.shape[1] + 1), np.uint64)
    for j in range(matrix.shape[1]):
        out[:, j + 1] = out[:, j] * BASE + (matrix[:, j].astype(np.uint64) + np.uint64(1))
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class Steps:
    """Which pieces may follow which: sorted pairs of ids (left << 32 | right), and whether they fit."""

    def __init__(self) -> None:
        self.keys, self.fit = np.empty(0, np.int64), np.empty(0, bool)

    def find(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether each pair is known, whether it fits)."""
        if not len(self.keys):
            return np.zeros(len(pairs), bool), np.zeros(len(pairs), bool)
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return self.keys[at] == pairs, self.fit[at]

    def learn(self, pairs: np.ndarray, fit: np.ndarray) -> None:
        if len(self.keys) > HELD_STEPS:
            self.keys, self.fit = np.empty(0, np.int64), np.empty(0, bool)
        keys = np.concatenate((self.keys, pairs))
        order = np.argsort(keys, kind="stable")
        self.keys, self.fit = keys[order], np.concatenate((self.fit, fit))[order]


@dataclass(frozen=True)
class Pieces:
    """A model's pieces: sorted hashes with ids and scores, and what each id decodes to."""

    keys: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    table: np.ndarray
    longest: int
    unknown: float
    in_pieces: np.ndarray  # by code point: whether some piece has it
    crossing: bool  # whether a piece has a space mark after another character
    byte_ids: np.ndarray
    raw: np.ndarray  # all ids' bytes
    raw_offsets: np.ndarray
    score_of: dict[str, float]
    id_of: dict[str, int]
    names: list[str]
    made: np.ndarray = field(default_factory=lambda: np.empty(0, bool))  # by id: whether merging gives it
    alone: np.ndarray = field(default_factory=lambda: np.empty(0, bool))  # by code point: whether it is a piece
    steps: Steps = field(default_factory=Steps)


def load_pieces(path: str) -> Pieces:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    number = model.get_piece_size()
    by_length: dict[int, list[int]] = {}
    raw, byte_ids = [], np.full(256, model.unk_id(), np.int32)
    names = [model.id_to_piece(i) for i in range(number)]
    for i, name in enumerate(names):
        if model.is_byte(i):
            value = int(name[1:-1], 16)
            byte_ids[value] = i
            raw.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            raw.append(b"")
        else:
            by_length.setdefault(len(name), []).append(i)
            raw.append(name.replace(chr(MARK), " ").encode())
    ids = np.concatenate([np.array(v) for v in by_length.values()])
    keys = np.concatenate(
        [_hashes(np.stack([_codes(names[i]) for i in v]))[:, -1] for v in by_length.values()])
    if len(np.unique(keys)) < len(keys):
        raise ValueError("two pieces share a hash")
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    scores = np.array([model.get_score(int(i)) for i in ids])
    table = np.zeros(1 << TABLE_BITS, bool)
    table[keys >> np.uint64(64 - TABLE_BITS)] = True
    in_pieces = np.zeros(0x110000, bool)
    in_pieces[np.unique(np.concatenate([_codes(names[i]) for i in ids]))] = True
    mark = chr(MARK)
    alone = np.zeros(0x110000, bool)
    alone[[ord(names[i]) for i in by_length.get(1, ())]] = True
    model_pieces = Pieces(
        keys, ids.astype(np.int32), scores, table, max(by_length), float(scores.min()) - UNKNOWN_PENALTY, in_pieces,
        any(mark in names[i].lstrip(mark) for i in ids), byte_ids,
        np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))),
        {names[i]: float(score) for i, score in zip(ids, scores)}, {names[i]: int(i) for i in ids}, names,
        np.zeros(number, bool), alone)
    for v in by_length.values():
        _, count = merges(model_pieces, np.stack([_codes(names[i]) for i in v]))
        model_pieces.made[v] = count == 1
    return model_pieces


def _look_up(model: Pieces, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, entries) of the hashes that are a piece's."""
    rows = np.flatnonzero(model.table[hashes >> np.uint64(64 - TABLE_BITS)])
    entry = np.minimum(np.searchsorted(model.keys, hashes[rows]), len(model.keys) - 1)
    right = model.keys[entry] == hashes[rows]
    return rows[right], entry[right]


def _powers(longest: int) -> np.ndarray:
    """BASE to the power of each length up to the longest."""
    return np.append(np.uint64(1), np.cumprod(np.full(longest, BASE)))


def viterbi(model: Pieces, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of equally long words, one word a row: (ids from the last piece on, how many)."""
    n, size = words.shape
    prefix = _hashes(words)
    best = np.full((size + 1, n), -np.inf)
    best[0] = 0
    back = np.ones((size + 1, n), np.int32)
    piece = np.full((size + 1, n), UNKNOWN, np.int32)
    power = _powers(model.longest)
    for end in range(1, size + 1):
        for k in range(min(end, model.longest), 0, -1):
            rows, entry = _look_up(model, prefix[:, end] - prefix[:, end - k] * power[k])
            score = best[end - k, rows] + model.scores[entry]
            better = score > best[end, rows]
            rows = rows[better]
            best[end, rows], back[end, rows], piece[end, rows] = score[better], k, model.ids[entry[better]]
            if k == 1:  # a character without a piece of its own
                lone = np.ones(n, bool)
                lone[rows] = False
                score = best[end - 1] + model.unknown
                lone &= score > best[end]
                best[end, lone], back[end, lone], piece[end, lone] = score[lone], 1, UNKNOWN
    return _traced(piece, back)


def _merged_long(model: Pieces, word: np.ndarray) -> list[int]:
    """Where the pieces of one word end that begin at each place, 0 where none begins."""
    text, size = word.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), len(word)
    after, before, waiting = list(range(1, size + 1)), list(range(-1, size)), []

    def wait(left: int) -> None:
        middle = after[left]
        if middle < size:
            end = after[middle]
            score = model.score_of.get(text[left:end]) if end - left <= model.longest else None
            if score is not None:
                heapq.heappush(waiting, (-score, left, middle, end))

    for left in range(size - 1):
        wait(left)
    while waiting:
        _, left, middle, end = heapq.heappop(waiting)
        if after[left] == middle and after[middle] == end:  # both still stand as they were
            after[left], after[middle], before[end] = end, 0, left
            wait(left)
            if before[left] >= 0:
                wait(before[left])
    return after


def merges(model: Pieces, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of equally long words as merging in rank order gives them, in the form of ``viterbi``."""
    n, size = words.shape
    prefix, power = _hashes(words), _powers(model.longest)
    if size > LONG_WORD:
        after = np.array([_merged_long(model, w) for w in words]).reshape(n, size)
    else:
        after = np.tile(np.arange(1, size + 1), (n, 1))  # where the piece from each place ends, 0 inside a piece
        before = np.tile(np.arange(-1, size), (n, 1))  # where the piece before each place begins
        score = np.full((n, size), -np.inf)

        def rate(rows: np.ndarray, left: np.ndarray) -> None:
            middle = after[rows, left]
            end = after[rows, np.minimum(middle, size - 1)]
            length = end - left
            fits = np.flatnonzero((middle < size) & (length <= model.longest))
            score[rows, left] = -np.inf
            rows, left, length, end = rows[fits], left[fits], length[fits], end[fits]
            found, entry = _look_up(model, prefix[rows, end] - prefix[rows, left] * power[length])
            score[rows[found], left[found]] = model.scores[entry]

        rows = np.arange(n)
        for left in range(size - 1):
            rate(rows, np.full(n, left))
        while len(rows):
            left = score[rows].argmax(axis=1)
            going = score[rows, left] > -np.inf
            rows, left = rows[going], left[going]
            middle = after[rows, left]
            end = after[rows, middle]
            after[rows, left], after[rows, middle], before[rows, end] = end, 0, left
            score[rows, middle] = -np.inf
            rate(rows, left)
            first = before[rows, left]
            inner = first >= 0
            rate(rows[inner], first[inner])
    begins = after > 0
    count = begins.sum(axis=1)
    rows, left = np.nonzero(begins)
    end = after[rows, left]
    ids = np.full(len(rows), UNKNOWN, np.int32)
    short = np.flatnonzero(end - left <= model.longest)
    found, entry = _look_up(model, prefix[rows, end][short] - prefix[rows, left][short] * power[(end - left)[short]])
    ids[short[found]] = model.ids[entry]
    out = np.full((n, size), UNKNOWN, np.int32)
    out[rows, count[rows] - np.cumsum(begins, axis=1)[rows, left]] = ids
    return out, count


def _admissible(model: Pieces, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether merging the text of two pieces gives these two, for each pair of ids."""
    pairs, which = np.unique(left.astype(np.int64) << 32 | right, return_inverse=True)
    known, fit = model.steps.find(pairs)
    if not known.all():
        new = pairs[~known]
        found = np.zeros(len(new), bool)
        by_length: dict[int, list[int]] = {}
        for i, (a, b) in enumerate(zip((new >> 32).tolist(), (new & 0xFFFFFFFF).tolist())):
            by_length.setdefault(len(model.names[a]) + len(model.names[b]), []).append(i)
        for rows in by_length.values():
            a, b = new[rows] >> 32, new[rows] & 0xFFFFFFFF
            out, count = merges(model, np.stack([_codes(model.names[x] + model.names[y]) for x, y in zip(a.tolist(), b.tolist())]))
            found[rows] = (count == 2) & (out[:, 0] == b) & (out[:, 1] == a)
        model.steps.learn(new, found)
        fit[~known] = found
    return fit[which]


def _alone(model: Pieces, word: np.ndarray) -> list[int]:
    """Ids of one word, the last first: the search of ``ranked_viterbi`` for a word of any length."""
    text, size = word.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), len(word)
    best, back, piece = [0.0] + [-np.inf] * size, [0] * (size + 1), [UNKNOWN] * (size + 1)
    fits: dict[tuple[int, int], bool] = {}
    for end in range(1, size + 1):
        for k in range(min(end, model.longest), 0, -1):
            right = model.id_of.get(text[end - k : end])
            if right is None or not model.made[right] or best[end - k] == -np.inf:
                continue
            left = piece[end - k]
            if end > k:
                fit = fits.get((left, right))
                if fit is None:
                    fit = fits[left, right] = bool(_admissible(model, np.array([left]), np.array([right]))[0])
                if not fit:
                    continue
            score = best[end - k] + model.score_of[text[end - k : end]]
            if score > best[end]:
                best[end], back[end], piece[end] = score, k, right
    out, end = [], size
    while end:
        out.append(piece[end])
        end -= back[end]
    return out


def ranked_viterbi(model: Pieces, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of equally long words of a model of merges, in the form of ``viterbi``."""
    n, size = words.shape
    lone = ~model.alone[words].all(axis=1)
    if lone.any():  # a character that is a piece only with others: its merges are taken as they come
        out, count = np.full((n, size), UNKNOWN, np.int32), np.zeros(n, np.int64)
        out[lone], count[lone] = merges(model, words[lone])
        if not lone.all():
            out[~lone], count[~lone] = ranked_viterbi(model, words[~lone])
        return out, count
    if size > LONG_WORD:
        lists = [_alone(model, w) for w in words]
        count = np.array([len(x) for x in lists])
        out = np.full((n, size), UNKNOWN, np.int32)
        out[np.arange(size) < count[:, None]] = np.concatenate(lists)
        return out, count
    prefix, power = _hashes(words), _powers(model.longest)
    best = np.full((size + 1, n), -np.inf)
    best[0] = 0
    back = np.ones((size + 1, n), np.int32)
    piece = np.full((size + 1, n), UNKNOWN, np.int32)
    for end in range(1, size + 1):
        rows, entry, length = [], [], []
        for k in range(min(end, model.longest), 0, -1):
            row, hit = _look_up(model, prefix[:, end] - prefix[:, end - k] * power[k])
            rows.append(row)
            entry.append(hit)
            length.append(np.full(len(row), k))
        rows, entry, length = np.concatenate(rows), np.concatenate(entry), np.concatenate(length)
        good = model.made[model.ids[entry]] & (best[end - length, rows] > -np.inf)
        rows, entry, length = rows[good], entry[good], length[good]
        inner = np.flatnonzero(length < end)
        fit = _admissible(model, piece[end - length[inner], rows[inner]], model.ids[entry[inner]])
        score = best[end - length, rows] + model.scores[entry]
        score[inner[~fit]] = -np.inf
        for k in np.unique(length)[::-1].tolist():  # the longer of equally good last pieces comes first
            of_k = np.flatnonzero(length == k)
            better = of_k[score[of_k] > best[end, rows[of_k]]]
            at = rows[better]
            best[end, at], back[end, at], piece[end, at] = score[better], k, model.ids[entry[better]]
    return _traced(piece, back)


def _traced(piece: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces along the backpointers, from the last one on, and how many."""
    size, n = piece.shape[0] - 1, piece.shape[1]
    out = np.full((n, size), UNKNOWN, np.int32)
    count = np.zeros(n, np.int64)
    at, alive = np.full(n, size), np.arange(n)
    while len(alive):
        out[alive, count[alive]] = piece[at[alive], alive]
        at[alive] -= back[at[alive], alive]
        count[alive] += 1
        alive = alive[at[alive] > 0]
    return out, count


Cut = Callable[[Pieces, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _encode_words(model: Pieces, words: np.ndarray, cut: Cut) -> tuple[np.ndarray, np.ndarray]:
    """(all ids one word after the other, how many each) of equally long words."""
    out, count = cut(model, words)
    column = count[:, None] - 1 - np.arange(out.shape[1])
    filled = column >= 0
    ids = np.take_along_axis(out, np.maximum(column, 0), axis=1)
    if not (ids[filled] == UNKNOWN).any():
        return ids[filled], count
    rows, place = [], np.flatnonzero((ids == UNKNOWN).any(axis=1) & True)
    lists = [row[: int(n)] for row, n in zip(ids, count)]
    for i in place:
        where, parts = 0, []
        for value in lists[i]:
            if value == UNKNOWN:
                parts.extend(model.byte_ids[list(chr(words[i, where]).encode())])
                where += 1
            else:
                parts.append(value)
                where += len(_piece_text(model, int(value)))
        lists[i] = np.array(parts, np.int32)
    rows = np.array([len(x) for x in lists])
    return np.concatenate(lists), rows


def _piece_text(model: Pieces, number: int) -> str:
    return model.raw[model.raw_offsets[number] : model.raw_offsets[number + 1]].tobytes().decode()


def _gather(values: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices values[b : b + n], one after the other."""
    total = np.cumsum(lengths)
    step = np.arange(total[-1] if len(total) else 0) - np.repeat(total - lengths, lengths)
    return values[np.repeat(begins, lengths) + step]


def encode_texts(model: Pieces, texts: list[str | None], cut: Cut = viterbi) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offsets between the texts)."""
    mark = chr(MARK)
    marked = [mark + t.replace(" ", mark) if t else "" for t in texts]
    codes = _codes("".join(marked))
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in marked], dtype=np.int64)))
    if not len(codes):
        return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    start = np.zeros(len(codes), bool)
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    foreign = ~model.in_pieces[codes]
    start |= foreign
    start[1:] |= foreign[:-1]
    if not model.crossing:
        start[1:] |= (codes[1:] == MARK) & (codes[:-1] != MARK)
    begins = np.flatnonzero(start)
    lengths = np.diff(np.append(begins, len(codes)))
    found_ids, found_begin, found_count, held = [], np.zeros(len(begins), np.int64), np.zeros(len(begins), np.int64), 0
    for size in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == size)
        words = codes[begins[rows][:, None] + np.arange(size)]
        _, sample, inverse = np.unique(_hashes(words)[:, -1], return_index=True, return_inverse=True)
        same = (words == words[sample[inverse]]).all(axis=1)
        if not same.all():  # words that share a hash with another are taken one by one
            sample = np.concatenate((sample, np.flatnonzero(~same)))
            inverse[~same] = np.arange(len(sample) - (~same).sum(), len(sample))
        ids, count = _encode_words(model, words[sample], cut)
        begin = held + np.cumsum(count) - count
        found_ids.append(ids)
        held += len(ids)
        found_begin[rows], found_count[rows] = begin[inverse], count[inverse]
    ids = _gather(np.concatenate(found_ids), found_begin, found_count)
    ends = np.concatenate(([0], np.cumsum(found_count)))
    return ids, ends[np.searchsorted(begins, offsets)]


def decode_ids(model: Pieces, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The texts of lists of ids, without the leading space that encoding added."""
    if not len(ids):
        return [""] * (len(offsets) - 1)
    lengths = np.diff(model.raw_offsets)[ids]
    data = _gather(model.raw, model.raw_offsets[ids], lengths).tobytes()
    ends = np.concatenate(([0], np.cumsum(lengths)))[offsets].tolist()
    texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
    return [t[1:] if t.startswith(" ") else t for t in texts]


# --- on DataFrames ------------------------------------------------------------------------------


def _encoded(
    batches: Iterator[pa.RecordBatch], model: Pieces, cut: Cut
) -> Iterator[tuple[pa.RecordBatch, list, np.ndarray, np.ndarray]]:
    for batch in pieces(batches, limit=CHUNK_BYTES):
        texts = batch.column("text").to_pylist()
        yield batch, texts, *encode_texts(model, texts, cut)


def encode(docs: DataFrame, model_file: str, cut: Cut = viterbi) -> DataFrame:
    """(doc_id, n_pieces, ids): one row per document. ``model_file`` is a path; one of merges needs ``cut=ranked_viterbi``."""
    model = load_pieces(model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, ids, offsets in _encoded(batches, model, cut):
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), lists], ["doc_id", "n_pieces", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_pieces bigint, ids array<int>")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, text) of encoded documents. Missing ids give an empty text."""
    model = load_pieces(model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [x or [] for x in batch.column("ids").to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64)))
            ids = np.fromiter((i for x in lists for i in x), np.int32, offsets[-1])
            texts = pa.array(decode_ids(model, ids, offsets), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def encode_and_decode(docs: DataFrame, model_file: str, cut: Cut = viterbi) -> DataFrame:
    """(doc_id, n_pieces, ids, text): the pieces of each document, and the text that they decode to."""
    model = load_pieces(model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, ids, offsets in _encoded(batches, model, cut):
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
            texts = pa.array(decode_ids(model, ids, offsets), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), lists, texts], ["doc_id", "n_pieces", "ids", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_pieces bigint, ids array<int>, text string")


def round_trip(docs: DataFrame, model_file: str, cut: Cut = viterbi) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, restored): encoded, decoded and compared with the text."""
    model = load_pieces(model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, ids, offsets in _encoded(batches, model, cut):
            raw = ids.astype("<u4").tobytes()
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            back = decode_ids(model, ids, offsets)
            same = [(t or "").replace(chr(MARK), " ") == b for t, b in zip(texts, back)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(sums, pa.int64()), pa.array(same, pa.bool_())],
                ["doc_id", "n_pieces", "ids_crc32", "restored"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_pieces bigint, ids_crc32 bigint, restored boolean")
