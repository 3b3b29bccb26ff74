"""The line field against enumeration, its gradient against differences, and planted lines."""

import random
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import quality_crf as q

FOLDER = "/root/testdata/sf0.1"


def enumerated(unary, stay):
    """(probability of good, of good-good and bad-bad after each line, log partition) of one chain."""
    n, total = len(unary), 0.0
    good, pairs = np.zeros(n), np.zeros((n, 2))
    for labels in product((0, 1), repeat=n):
        score = sum(u for u, y in zip(unary, labels) if y) + sum(stay[a] for a, b in zip(labels, labels[1:]) if a == b)
        weight = np.exp(score)
        total += weight
        good += weight * np.array(labels)
        for i, (a, b) in enumerate(zip(labels, labels[1:])):
            if a == b:
                pairs[i, a] += weight
    return good / total, pairs / total, np.log(total)


def test_several_chains_at_once():
    rng = np.random.default_rng(3)
    lengths, stay = [3, 1, 5, 2, 1, 4], rng.normal(size=2)
    text, unary = np.repeat(np.arange(len(lengths)), lengths), rng.normal(size=sum(lengths))
    prob, pairs, _, norm = q.chain(unary, text, stay)
    expected = [enumerated(unary[text == i], stay) for i in range(len(lengths))]
    assert prob == pytest.approx(np.concatenate([e[0] for e in expected]))
    assert pairs == pytest.approx(np.concatenate([e[1] for e in expected]))
    assert norm == pytest.approx(sum(e[2] for e in expected))
    size = rng.integers(1, 50, len(text)).astype(float)
    model = q.Model(np.array([1.0]), stay, (0.0, 1.0))
    found = q.text_quality(model, unary[:, None], text, size, len(lengths))
    assert found == pytest.approx([np.average(e[0], weights=size[text == i]) for i, e in enumerate(expected)])


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(4)
    text, width = np.repeat(np.arange(4), [3, 1, 4, 2]), 3
    x, labels = rng.normal(size=(len(text), width)), rng.integers(0, 2, len(text))
    p = rng.normal(size=width + 2) / 2
    inner = np.append(text[1:] == text[:-1], False)
    same = [(inner & (labels == y) & (np.roll(labels, -1) == y)).sum() for y in (0, 1)]
    observed = np.append(x.T @ labels, same)

    def likelihood(p):
        ridge = q.RIDGE * (p[:width] ** 2).sum() / 2 + q.STAY_RIDGE * (p[width:] ** 2).sum() / 2
        return (observed @ p - sum(enumerated((x @ p[:width])[text == i], p[width:])[2] for i in range(4))) / len(x) - ridge

    steps = np.eye(width + 2) * 1e-5
    numeric = [(likelihood(p + s) - likelihood(p - s)) / 2e-5 for s in steps]
    assert q.field_gradient(p, x, text, observed) == pytest.approx(np.array(numeric), abs=1e-6)


def test_features_of_a_small_text():
    texts = ["One two!\n\n  a|b #1\nOne two!", None, "", "  \n ", "é"]
    x, text, size = q.line_features(*q.text_bytes(pa.array(texts)))
    assert text.tolist() == [0, 0, 0, 1, 2, 3, 4] and size.tolist() == [9, 9, 8, 1, 1, 1, 1]
    kinds = ["#*$%&|<>", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "!?", "|", "0123456789", ".,;:", " \t\n\x0b\x0c\r"]
    for row, line in ((0, "One two!\n"), (1, "  a|b #1\n"), (2, "One two!")):
        assert x[row, : len(kinds)] == pytest.approx([4 * sum(c in k for c in line) / len(line) for k in kinds])
    assert x[0, q.OWN - 2] == 1 and x[1, q.OWN - 2] == 0  # ends like a sentence
    assert x[:, -3].tolist() == [1, 0, 0, 1, 1, 1, 1] and x[:, -2].tolist() == [0, 0, 1, 1, 1, 1, 1]
    lent = [x[1, b] for b in q.BESIDE]
    assert x[0, q.OWN + len(q.BESIDE) : q.OWN + 2 * len(q.BESIDE)] == pytest.approx(lent)
    assert x[2, q.OWN : q.OWN + len(q.BESIDE)] == pytest.approx(lent)


def test_planted_lines_get_both_labels(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    rows = sorted((r.doc_id, r.text, r.quality) for r in docs.join(labels, "doc_id").where("quality IS NOT NULL AND text IS NOT NULL").collect())
    x, text, size = q.line_features(*q.text_bytes(pa.array([r[1] for r in rows])))
    label = np.array([r[2] for r in rows])
    prose = [t for _, t, y in rows if y == 1 and "\n" in t and len(t) < 3000][:150]
    junk = [t for _, t, y in rows if y == 0 and t.strip() and len(t) < 3000]
    rng, mixed, truth = random.Random(1), [], []
    for t in prose:
        other = rng.choice(junk)
        mixed.append(t.rstrip("\n") + "\n" + other)
        truth += [1] * sum(bool(line.split()) for line in t.split("\n")) + [0] * sum(bool(line.split()) for line in other.split("\n"))
    mx, mtext, _ = q.line_features(*q.text_bytes(pa.array(mixed)))
    right, both = {}, {}
    for name, chained in (("field", True), ("lines", False)):
        model = q.fit(x, text, size, label, chained=chained)
        good = q.chain(mx.astype(float) @ model.weights, mtext, model.stay)[0] > 0.5
        right[name] = (good == np.array(truth)).mean()
        both[name] = np.mean([len(set(good[mtext == i].tolist())) == 2 for i in range(len(mixed))])
    assert right["field"] >= right["lines"] and right["field"] > 0.8
    assert both["field"] > 0.5


def test_sample_is_bounded_by_lines_and_rows(spark):
    rows = [(i, "good prose stands here\n" * 5) for i in range(40)] * 2 + [(7, "another row of this id"), (None, "x")]
    docs = spark.createDataFrame([(i, t, 0.1, True) for i, t in rows], "doc_id long, text string, score double, held_out boolean")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    chosen = q._sampled(docs, labels, 1000, 10**6)
    assert len(chosen) == len({c[0] for c in chosen}) > 20 and [c[3] for c in chosen] == list(range(len(chosen)))
    few = q._sampled(docs, labels, 1000, 20)
    assert few == chosen[: len(few)] and 0 < len(few) <= 4
    found = q.document_quality(docs, labels).collect()
    assert len(found) == len(rows) and q.good_documents(docs, labels).columns == docs.columns


def test_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "word " * 200_000 + "\n" + "x\n" * 5000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert q._sampled(docs, labels, 10, 10**6) == []
    assert [r.score for r in q.document_quality(docs, labels).collect()] == [0.5]
