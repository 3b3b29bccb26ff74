"""Document quality from a linear-chain conditional random field over lines.

Every line that has a word gets features of its own bytes, of its repeated three-word sequences in
the document and of the lines beside it. Two labels, good and bad, form a chain. A document's
quality is the mean of its lines' marginal probabilities of good, weighted by their length, put
through a logistic curve that is fitted with the field.

The field is fitted on at most SAMPLE labelled documents with at most LINES lines together (whole
documents of LONGEST lines at most, those first by a hash of the id). Their lines' labels are hidden: what is known is the
document's label, which each line bears out with odds of EVIDENCE to one. Beginning with single lines
that take their document's label, a few rounds of expectation put in the lines' posterior labels, from
the chain and that evidence, and fit the field to them. So a sound line of a bad document can be
good. Everything else sees all documents.

Defined cases: a missing or empty text, or one without a word, scores like a document of one line
without content; labels that are missing are not learned from, and repeated labels of one id count
once, by their mean; of several rows with a labelled id one is learned from; without any label every
score is 0.5; repeated rows are scored alike; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from tidemark.llm.chunks import pieces, text_bytes

SAMPLE = 6000
LINES = 400_000  # of the sample, held by the driver as features
LONGEST = 2000  # lines of a document to learn from
EVIDENCE = 10.0
ROUNDS = 3
HELD_OUT_OF, HELD_OUT = 3, 1
FIRST_STEPS, STEPS, RATE, RIDGE = 120, 60, 0.1, 1e-3
STAY_RIDGE = 0.1  # the evidence is shared by all lines of a text, which makes neighbours look more alike than they are

_is = lambda characters: np.isin(np.arange(256), np.frombuffer(characters, np.uint8))
SPACE = _is(b" \t\n\x0b\x0c\r")
KINDS = (
    _is(b"#*$%&|<>"),
    _is(bytes(range(65, 91))),
    _is(b"!?"),
    _is(b"|"),
    _is(bytes(range(48, 58))),
    _is(b".,;:"),
    SPACE,
)
ENDS = _is(b".!?:;\"')")
_rng = np.random.default_rng(7)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
PLACE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
MIX = _rng.integers(1, 2**63, 4, dtype=np.uint64) | np.uint64(1)

OWN = len(KINDS) + 6
BESIDE = (0, 1, 2, 3, OWN - 1)  # own features that the neighbouring lines lend
FEATURES = OWN + 2 * len(BESIDE) + 3


# --- features -----------------------------------------------------------------------------------


def _repeats(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin, and whether the three words from there occur more than once in the text."""
    word = ~SPACE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    cuts = offsets[:-1][np.diff(offsets) > 0]
    start[cuts] |= word[cuts]
    begins = np.flatnonzero(start)
    if not len(begins):
        return begins, np.empty(0, bool)
    place = np.arange(len(data)) - np.maximum.accumulate(np.where(start, np.arange(len(data)), 0))
    code = BYTE_CODE[data] * PLACE_CODE[place & 255]
    code[~word] = 0
    each = np.add.reduceat(code, begins)
    text = np.searchsorted(offsets, begins, side="right").astype(np.uint64)
    three = each * MIX[0] + text * MIX[3]
    three[:-1] += each[1:] * MIX[1]
    three[:-2] += each[2:] * MIX[2]
    _, inverse, counts = np.unique(three, return_inverse=True, return_counts=True)
    return begins, counts[inverse] > 1


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, text number and length of every line, at least one line for each text."""
    texts = len(offsets) - 1
    breaks = np.flatnonzero(data == 10) + 1
    starts = np.unique(np.concatenate((offsets[:-1][np.diff(offsets) > 0], breaks)))
    starts = starts[starts < len(data)]
    if len(starts):
        ends = np.append(starts[1:], len(data))
        total = lambda flags: np.add.reduceat(flags.astype(np.int32), starts).astype(np.float32)
        size = total((data & 0xC0) != 0x80)
        counts = [total(kind[data]) for kind in KINDS]
        begins, repeated = _repeats(data, offsets)
        of_word = np.searchsorted(starts, begins, side="right") - 1
        words = np.bincount(of_word, minlength=len(starts)).astype(np.float32)
        again = np.bincount(of_word, weights=repeated, minlength=len(starts)).astype(np.float32)
        visible = ~SPACE[data]
        last = np.maximum.accumulate(np.where(visible, np.arange(len(data)), -1))[ends - 1]
        filled = words > 0
        content = np.maximum(size - counts[-1], 1)
        own = np.stack(
            [
                *(c / np.maximum(size, 1) * 4 for c in counts),
                np.log1p(size) / 6,
                size < 20,
                words < 4,
                content / np.maximum(words, 1) / 10,
                ENDS[data[np.maximum(last, 0)]],
                again / np.maximum(words, 1),
            ],
            axis=1,
        ).astype(np.float32)[filled]
        text = (np.searchsorted(offsets, starts, side="right") - 1)[filled]
        size = size[filled]
    else:
        own, text, size = np.zeros((0, OWN), np.float32), np.empty(0, np.int64), np.empty(0, np.float32)
    # A text without a word has one line of zeros.
    bare = np.setdiff1d(np.arange(texts), text)
    text = np.concatenate((text, bare))
    order = np.argsort(text, kind="stable")
    own = np.concatenate((own, np.zeros((len(bare), OWN), np.float32)))[order]
    size = np.concatenate((size, np.ones(len(bare), np.float32)))[order]
    text = text[order]
    out = np.zeros((len(own), FEATURES), np.float32)
    out[:, :OWN] = own
    if len(own):
        same = text[1:] == text[:-1]
        n = len(BESIDE)
        out[1:, OWN : OWN + n] = own[:-1, BESIDE] * same[:, None]
        out[:-1, OWN + n : OWN + 2 * n] = own[1:, BESIDE] * same[:, None]
        out[1:, -3] = ~same
        out[0, -3] = 1
        out[:-1, -2] = ~same
        out[-1, -2] = 1
    out[:, -1] = 1
    return out, text, size


# --- the field ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Weights of good against bad, the reward for equal neighbours per label, and the final curve."""

    weights: np.ndarray
    stay: np.ndarray
    curve: tuple[float, float]


def chain(unary: np.ndarray, text: np.ndarray, stay: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Forward-backward over all chains at once, as log odds.

    Returns each line's probability of good, each neighbouring pair's probability of good-good and
    bad-bad (on the first of the pair, 0 at a chain's end), and the sum of the log partitions.
    The messages are log odds of good against bad; texts advance together, longest first.
    """
    n = len(unary)
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if n else np.empty(0, np.int64)
    length = np.diff(np.append(first, n))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    bad, good = float(stay[0]), float(stay[1])

    def passed(odds: np.ndarray) -> np.ndarray:
        # log(exp(odds + good) + 1) - log(exp(odds) + exp(bad))
        return np.logaddexp(odds + good, 0) - np.logaddexp(odds, bad)

    forward, backward, norm = np.zeros(n), np.zeros(n), np.zeros(len(first))
    longest = int(length.max(initial=0))
    for step in range(longest):
        at = first[: int(np.searchsorted(-length, -step, side="left"))] + step
        if step:
            before = forward[at - 1]
            norm[: len(at)] += np.logaddexp(before, bad)  # log weight of a bad line, given the line before
            forward[at] = unary[at] + passed(before)
        else:
            forward[at] = unary[at]
    for step in range(longest - 1):
        many = int(np.searchsorted(-length, -(step + 1), side="left"))
        at = first[:many] + length[:many] - 2 - step
        backward[at] = passed(unary[at + 1] + backward[at + 1])
    prob = 1 / (1 + np.exp(-np.clip(forward + backward, -50, 50)))
    pairs = np.zeros((n, 2))
    if n:
        inner = np.flatnonzero(text[1:] == text[:-1])
        left, right = forward[inner], unary[inner + 1] + backward[inner + 1]
        scores = np.stack([np.full(len(inner), bad), right, left, left + right + good], axis=1)
        scores -= scores.max(axis=1, keepdims=True)
        weight = np.exp(scores)
        weight /= weight.sum(axis=1, keepdims=True)
        pairs[inner, 0], pairs[inner, 1] = weight[:, 0], weight[:, 3]
    total = float(norm.sum() + np.logaddexp(0, forward[first + length - 1]).sum()) if n else 0.0
    return prob, pairs, first, total


def text_quality(model: Model, x: np.ndarray, text: np.ndarray, size: np.ndarray, texts: int) -> np.ndarray:
    """The length-weighted mean of the lines' probabilities of good."""
    prob, _, _, _ = chain(x @ model.weights, text, model.stay)
    weight = np.bincount(text, weights=size, minlength=texts)
    return np.bincount(text, weights=size * prob, minlength=texts) / np.maximum(weight, 1e-9)


def _adam(gradient, start: np.ndarray, steps: int) -> np.ndarray:  # noqa: ANN001
    value, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(value)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        value += RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8) * (1 - t / (steps + 1))
    return value


def expected(
    p: np.ndarray, x: np.ndarray, text: np.ndarray, label: np.ndarray, evidence: float = EVIDENCE
) -> tuple[np.ndarray, np.ndarray]:
    """Each line's probability of good and each pair's of good-good and bad-bad, given the documents' labels too."""
    width = x.shape[1]
    told = np.log(evidence) * (2.0 * label[text] - 1)
    prob, pairs, _, _ = chain(x @ p[:width] + told, text, p[width:])
    return prob, pairs


def field_gradient(p: np.ndarray, x: np.ndarray, text: np.ndarray, observed: np.ndarray) -> np.ndarray:
    """Of the likelihood of line labels with the observed statistics: these less the expected ones."""
    width = x.shape[1]
    prob, pairs, _, _ = chain(x @ p[:width], text, p[width:])
    ridge = np.append(np.full(width, RIDGE), [STAY_RIDGE, STAY_RIDGE])
    return (observed - np.append(x.T @ prob, pairs.sum(axis=0))) / len(x) - ridge * p


def fit(
    x: np.ndarray, text: np.ndarray, size: np.ndarray, label: np.ndarray, rounds: int = ROUNDS, chained: bool = True
) -> Model:
    """Weights under which hidden line labels explain the labels of the texts, with a ridge; then the curve.

    Without ``chained`` the lines stay independent, without ``rounds`` they take their text's label.
    """
    texts, width = len(label), x.shape[1]
    if not texts:
        return Model(np.zeros(width), np.zeros(2), (0.0, 0.0))
    x, y = x.astype(np.float64), label[text].astype(np.float64)
    free = np.append(np.ones(width), np.zeros(2))  # single lines first
    observed = np.append(x.T @ y, [0.0, 0.0])
    p = _adam(lambda q: field_gradient(q, x, text, observed) * free, np.zeros(width + 2), FIRST_STEPS)
    free[width:] = chained
    for _ in range(rounds):
        prob, pairs = expected(p, x, text, label)
        observed = np.append(x.T @ prob, pairs.sum(axis=0))
        p = _adam(lambda q: field_gradient(q, x, text, observed) * free, p, STEPS)
    field = Model(p[:width], p[width:], (0.0, 0.0))
    quality = text_quality(field, x, text, size, texts)
    basis = np.stack([np.ones(texts), _logit(quality)], axis=1)
    curve = _adam(lambda c: basis.T @ (label - 1 / (1 + np.exp(-basis @ c))) / texts - 1e-4 * c, np.array([0.0, 1.0]), 800)
    return Model(p[:width], p[width:], (float(curve[0]), float(curve[1])))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def score_texts(model: Model, column: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(column)
    x, text, size = line_features(data, offsets)
    quality = text_quality(model, x, text, size, len(column))
    return 1 / (1 + np.exp(-(model.curve[0] + model.curve[1] * _logit(quality))))


# --- on DataFrames ------------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT_OF == HELD_OUT, F.lit(False))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        x, text, size = line_features(*text_bytes(batch.column("text")))
        ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
        rows = [(x[a:b].tobytes(), size[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("nth"), batch.column("label"), *(pa.array(c, pa.binary()) for c in zip(*rows))],
            ["nth", "label", "x", "size"])


def _sampled(docs: DataFrame, labels: DataFrame, sample: int, lines: int, longest: int = LONGEST) -> list[tuple]:
    """(doc_id, hash of the text, label, number) of the documents to fit on, a row of two numbers for each."""
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    )
    key = F.md5(F.col("doc_id").cast("string")).alias("key")
    # At most ``sample`` rows: small enough to send to every task.
    chosen = F.broadcast(known.orderBy(key, "doc_id").limit(sample))
    text = F.coalesce("text", F.lit(""))
    found = docs.join(chosen, "doc_id").select(
        "doc_id", "label", F.xxhash64(text).alias("code"), (F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).alias("lines"))
    one = found.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("code").alias("code"), F.min_by("lines", "code").alias("lines"))
    out, held = [], 0
    for row in one.orderBy(key, "doc_id").collect():
        if row["lines"] > longest:
            continue
        held += row["lines"]
        if held > lines and out:
            break
        out.append((row["doc_id"], row["code"], row["label"], len(out)))
    return out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lines: int = LINES) -> Model:
    """Fit on the labelled documents that are not held out, ``sample`` of them and ``lines`` lines at most."""
    chosen = _sampled(docs, labels, sample, lines)
    if not chosen:
        return fit(np.zeros((0, FEATURES)), np.empty(0, np.int64), np.empty(0), np.empty(0))
    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = F.broadcast(docs.sparkSession.createDataFrame(chosen, f"doc_id {kind}, code bigint, label int, nth int"))
    rows = (
        docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("code"))
        .join(wanted, ["doc_id", "code"]).select("nth", "label", "text")
        .mapInArrow(_feature_batches, "nth int, label int, x binary, size binary")
        .dropDuplicates(["nth"]).collect()
    )
    rows = sorted(rows, key=lambda r: r["nth"])
    sizes = [np.frombuffer(r["size"], np.float32) for r in rows]
    x = np.frombuffer(b"".join(r["x"] for r in rows), np.float32).reshape(-1, FEATURES)
    text = np.repeat(np.arange(len(rows)), [len(s) for s in sizes])
    return fit(x, text, np.concatenate(sizes), np.array([r["label"] for r in rows]))


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """The given columns and the score as a last one; a column of that name is replaced."""
    docs = docs.drop(name)
    schema = to_arrow_schema(docs.schema)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            score = pa.array(score_texts(model, batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], [*batch.schema.names, name])

    return docs.mapInArrow(scored, from_arrow_schema(schema.append(pa.field(name, pa.float64()))))


def document_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per document."""
    narrow = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return with_score(narrow, train(docs, labels, sample)).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents predicted to be good, in their own columns."""
    score = "__score__"
    return with_score(docs, train(docs, labels, sample), score).where(F.col(score) >= 0.5).select(*docs.columns)
