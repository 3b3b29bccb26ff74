"""Every license rule passes its keywords and fires on each spelling that its pattern accepts."""

import itertools
import re

import pytest

from tidemark.llm import licenses


def word_spellings(word):
    """The forms of one word of a name: alternatives, an optional character, a choice of characters."""
    optional = word.endswith("?")
    word = word[:-1] if optional else word
    group = re.fullmatch(r"\((.*)\)", word)
    found = []
    for w in group[1].split("|") if group else [word]:
        choice = re.search(r"\[(\w+)\]", w)
        for one in [w.replace(choice[0], c) for c in choice[1]] if choice else [w]:
            found += [one.replace("v?", "v"), one.replace("v?", "")] if "v?" in one else [one]
    return found + [""] * optional


def spellings(name):
    for words in itertools.product(*map(word_spellings, name.split(" "))):
        yield " ".join(w for w in words if w)


def spaced(text):
    return "".join(f" {w} " for w in text.split())


def test_keywords_are_in_every_spelling():
    rules = {(r.label, r.pattern): r for r in licenses.RULES}
    for label, _, identifier, name in licenses.NAMES:
        for words in (name, f"spdx license identifier {identifier}"):
            rule = rules[label, licenses.word_pattern(words)]
            for text in spellings(words):
                assert re.search(rule.pattern, spaced(text)), (label, text)
                assert set(rule.keywords) <= set(text.split()), (label, text)
        grant = f"{licenses.GRANT} {name}"
        rule = rules[label, licenses.word_pattern(grant)]
        for text in spellings(name):
            assert set(rule.keywords) <= {"licensed", "under", *text.split()}, (label, text)


def test_every_name_is_detected(spark):
    texts = [(label, text) for label, _, _, name in licenses.NAMES for text in spellings(name)]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    found = {}
    for r in licenses.detections(docs).where("rule IS NOT NULL").select("doc_id", "rule").collect():
        found.setdefault(r.doc_id, set()).add(licenses.RULES[r.rule].label)
    for i, (label, text) in enumerate(texts):
        assert label in found.get(i, ()), (label, text)


@pytest.mark.parametrize("text, label", [
    ("Creative Commons Attribution ShareAlike 4.0", "cc-by-sa-4.0"),
    ("Licensed under the Creative Commons Attribution-NonCommercial license", "cc-by-nc"),
    ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0", "cc-by-nc-nd-4.0"),
    ("CC BY-ND", "cc-by-nd"),
])
def test_creative_commons_labels(spark, text, label):
    row = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert label in row.labels.split(",")
