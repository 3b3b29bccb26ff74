"""Missing, empty, long and repeated rows, clashing columns and empty tables for the built-in operators."""

import pytest

from tidemark.llm import licenses, line_rules, sharding

COLUMNS = "doc_id long, text string, words string, row string, shard string"
ROWS = [(1, None, "a", "b", "c"), (2, "", "a", "b", "c"), (None, "MIT License", "a", "b", "c"),
        (3, "word " * 30000, "a", "b", "c"), (3, "word " * 30000, "a", "b", "c")]


@pytest.mark.parametrize("run", [licenses.scan_licenses, line_rules.judged_documents, sharding.shard_documents])
def test_every_row_has_one(spark, run):
    found = run(spark.createDataFrame(ROWS, COLUMNS)).collect()
    assert sorted(r.doc_id or 0 for r in found) == [0, 1, 2, 3, 3]
    assert run(spark.createDataFrame([], COLUMNS)).collect() == []


def test_license_values(spark):
    found = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(ROWS, COLUMNS)).collect()}
    assert (found[1].n_words, found[1].n_base, found[1].first_word, found[1].labels, found[1].score) == (0, 0, None, "", 0)
    assert (found[None].n_base, found[None].first_word, found[None].base_labels) == (1, 0, "mit")


def test_shard_slots_have_no_gaps(spark):
    slots = {}
    for r in sharding.shard_documents(spark.createDataFrame(ROWS, COLUMNS)).collect():
        slots.setdefault(r["shard"], []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
