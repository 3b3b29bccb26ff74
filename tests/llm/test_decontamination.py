"""Passages found with edits, against the plain dynamic programme."""

import random

import numpy as np
import pytest

from tidemark.llm import decontamination as d


def least_edits(passage, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(passage, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(rng, passage, edits):
    out = list(passage)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcde")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rng.choice("abcde"))
    return "".join(out)


WORDS = ["the", "thin", "ation", "ere", "ou", "stre", "one", "at", "ing", "wh", "ea", "nd"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def case():
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randint(4, 30))) for i in range(12)] + [(100, "short"), (101, None), (102, "")]
    docs = [(1000, None), (1001, ""), (1002, "short")]
    for n in range(60):
        _, item = items[rng.randrange(12)]
        middle = edited(rng, item, rng.randint(0, max(1, len(item) // 8)))
        parts = [prose(rng, rng.randint(0, 25)), middle, prose(rng, rng.randint(0, 25))]
        docs.append((n, [" ", "\n", ". "][n % 3].join(parts).upper() if n % 2 else " ".join(parts)))
    return items, docs


def test_equals_the_plain_programme(spark, case):
    items, docs = case
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, edits int").repartition(3)
    places = d.find_passages(table, benchmark).collect()
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in sorted(places, key=lambda r: -r["edits"])}
    expected = {}
    for i, text in docs:
        low = d.folded_passage(text)
        for item, passage in items:
            p = d.folded_passage(passage)
            if len(p) >= d.Q:
                edits = least_edits(p, low)
                if edits <= d.edit_budget(len(p)):
                    expected[i, item] = edits
            elif p and b" " + p + b" " in b" " + low + b" ":
                expected[i, item] = 0
    assert len(expected) > 20
    assert found == expected
    texts = dict(docs)
    for r in places:
        place = d.folded_passage(texts[r["doc_id"]][r["start"] : r["end"]])
        assert least_edits(d.folded_passage(dict(items)[r["item_id"]]), place) == r["edits"]
    kept = d.without_passages(table, benchmark)
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in expected}


def test_every_place_of_a_passage(spark):
    rng = random.Random(8)
    items = [(1, prose(rng, 12)), (2, prose(rng, 30)), (3, "one and the same " * 4), (1, None)]
    rows, planted = [], {}
    for n in range(40):
        text, places = prose(rng, 3), []
        for _ in range(rng.randint(0, 4)):
            item, passage = items[rng.randrange(2)]
            changed = edited(rng, passage, rng.randint(0, 3))
            places.append((item, len(text) + 1, len(text) + 1 + len(changed)))
            text += f" {changed} {prose(rng, rng.randint(0, 9))}"
        rows.append((n, text))
        planted[n] = places
    rows += [(100, items[2][1] * 3), (101, items[2][1] * 3), (101, items[2][1] * 3)]
    table, benchmark = (spark.createDataFrame(x, s) for x, s in ((rows, "doc_id long, text string"), (items * 2, "item_id long, text string")))
    found = d.find_passages(table, benchmark).collect()
    for n, places in planted.items():
        got = sorted((r["item_id"], r["start"], r["end"]) for r in found if r["doc_id"] == n)
        assert [g[0] for g in got] == sorted(p[0] for p in places)
        for (_, start, end), (_, begin, last) in zip(got, sorted(places)):
            assert abs(start - begin) <= 6 and abs(end - last) <= 6
    assert [sum(r["doc_id"] == i for r in found) for i in (100, 101)] == [3, 6]


def test_short_passages_are_whole_words(spark):
    items = [(1, "2+2=4"), (2, "yes"), (3, "Yes!"), (4, "é"), (None, "no id"), (6, "..."), (7, "abcdefg")]
    texts = ["2 + 2 = 4", "yes", "yesterday, yes", "x yes.", "", "é, éa", "no id", "12+2=4", "2+2", "abcdefg abcdefgh", None, "...", "ye", "s yes"]
    table, benchmark = (spark.createDataFrame(x, s) for x, s in (
        (list(enumerate(texts)) + [(2, texts[2])], "doc_id long, text string"), (items, "item_id long, text string")))
    found = sorted((r["doc_id"], r["item_id"] or 0, r["start"], r["end"]) for r in d.find_passages(table.repartition(1), benchmark).collect())
    expected = [(0, 1, 0, 9), (1, 2, 0, 3), (1, 3, 0, 3), *[(2, i, 11, 14) for i in (2, 2, 3, 3)], (3, 2, 2, 5), (3, 3, 2, 5),
                (5, 4, 0, 1), (6, 0, 0, 5), (9, 7, 0, 7), (13, 2, 2, 5), (13, 3, 2, 5)]
    assert found == expected
    assert sorted(r["doc_id"] for r in d.without_passages(table, benchmark).collect()) == [4, 7, 8, 10, 11, 12]


def test_blocks_of_passages_and_pieces_of_text(spark, case, monkeypatch):
    items, docs = case
    block = [(i, d.folded_passage(t)) for i, t in items if t]
    index = d.PassageIndex(block)
    monkeypatch.setattr(d, "SCAN_BYTES", 50)
    for _, text in docs:
        low = np.frombuffer(d.folded_passage(text), np.uint8)
        cut = sorted(map(tuple, zip(*(x.tolist() for x in index.shared(low)))))
        monkeypatch.setattr(d, "SCAN_BYTES", 1 << 20)
        assert cut == sorted(map(tuple, zip(*(x.tolist() for x in index.shared(low)))))
        monkeypatch.setattr(d, "SCAN_BYTES", 50)
    monkeypatch.setattr(d, "BLOCK_BYTES", 300)
    table, benchmark = (spark.createDataFrame(x, s) for x, s in (
        (docs, "doc_id long, text string"), (items, "item_id long, text string")))
    assert len(list(d._blocks(benchmark))) > 2
    assert all(sum(len(p) for _, p in block) <= 300 or len(block) == 1 for block in d._blocks(benchmark))
    many = sorted(map(tuple, d.find_passages(table, benchmark).collect()))
    clean = sorted(r["doc_id"] for r in d.without_passages(table, benchmark).collect())
    monkeypatch.setattr(d, "BLOCK_BYTES", 1 << 20)
    assert many == sorted(map(tuple, d.find_passages(table, benchmark).collect()))
    assert clean == sorted(r["doc_id"] for r in d.without_passages(table, benchmark).collect())


def test_empty_tables(spark, case):
    items, docs = case
    table, benchmark = (spark.createDataFrame(x, s) for x, s in (
        (docs, "doc_id long, text string"), (items, "item_id long, text string")))
    assert d.find_passages(table.limit(0), benchmark).count() == 0
    assert d.find_passages(table, benchmark.limit(0)).count() == 0
    assert d.without_passages(table, benchmark.limit(0)).count() == len(docs)
