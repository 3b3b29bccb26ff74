"""The near-duplicate stage against all pairs, and what the rules stage leaves of a text."""

import random

import numpy as np
from test_simhash import slow_components, slow_fingerprint

import corpus_pipeline
from tidemark.llm import decontamination, line_rules, quality_crf, simhash


def test_one_row_of_each_component(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = ["", "", "one", "One"]
    for _ in range(12):
        text = rng.choices(words, k=rng.randint(5, 300))
        texts.append(" ".join(text))
        texts += [" ".join(text)] * rng.randint(0, 6)
        text[rng.randrange(len(text))] = "changed"
        texts.append(" ".join(text))
    rng.shuffle(texts)
    rows = [(i, t, "print") for i, t in enumerate(texts)]
    root = slow_components([slow_fingerprint(t) for t in texts])
    docs = spark.createDataFrame(rows, "doc_id long, text string, __node__ string")
    found = simhash.one_per_group(docs)
    assert found.columns == docs.columns
    assert sorted(map(tuple, found.collect())) == sorted(rows[i] for i in range(len(rows)) if root[i] == i)


def test_rows_with_one_id_and_without(spark):
    rows = [(5, "x y z first text", {"a": 1}), (5, "quite another text", {"a": 1}), (3, "quite another text", {"a": 2}),
            (None, "x y z first text", None), (None, None, None), (7, None, None), (8, "", None), (3, "quite another text", {"a": 2})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind map<string,int>")
    found = sorted(((r.doc_id or 0, r.text or "") for r in simhash.one_per_group(docs).collect()))
    assert found == [(0, ""), (0, "x y z first text"), (3, "quite another text"), (5, "x y z first text"), (7, "")]
    assert simhash.one_per_group(docs.where("doc_id > 9")).collect() == []


def test_clean_texts_come_back_byte_for_byte(spark):
    prose = "Ten plain words stand here so that no base rule fails."
    texts = [f"{prose}\n\n  Another paragraph follows, quite unlike that one.\n", f"\n{prose}\r\n\n\n", f"{prose}\n\nclick here\n\nmore of it all\n", f"{prose}\n###\n"]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int")
    found = {r.doc_id: (r.text, r.n_chars) for r in line_rules.cleaned_documents(docs).collect()}
    expected = {0: texts[0], 1: texts[1], 2: f"{prose}\n\n\nmore of it all\n", 3: f"{prose}\n"}
    assert found == {i: (t, len(t)) for i, t in expected.items()}


def test_a_cell_of_more_fingerprints_than_a_task_compares(spark):
    """Nine thousand fingerprints that agree in four blocks: the cell is cut into parts, every two compared in a task."""
    rng = random.Random(6)
    seeds = [rng.getrandbits(20) for _ in range(3000)]
    prints = set()
    while len(prints) < 2 * simhash.PART + 900:  # near ones around the seeds, all in the low bits
        value = rng.choice(seeds)
        for bit in rng.sample(range(26), rng.randint(0, 3)):
            value ^= 1 << bit
        prints.add(value)
    nodes = spark.createDataFrame([(p,) for p in sorted(prints)], "print bigint").repartition(5)
    links = simhash.fingerprint_links(nodes)
    found = {r.node: r.root for r in simhash.components(links).collect()}
    values = np.array(sorted(prints), np.uint64)
    a, b = simhash.close_pairs(values, values, same=True)
    node, root = simhash.forest(values, a, b)
    assert len(set(root.tolist())) > 1 and found == dict(zip(node.tolist(), root.tolist()))


def test_stages_keep_what_their_operators_say(spark):
    """The documents that pass each stage, against the operator's own verdicts on what came in."""
    folder = "/root/testdata/sf0.001"
    labels, benchmark = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("labels", "benchmark"))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    verdicts = {
        "quality_classifier": lambda d: ids(quality_crf.document_quality(d, labels).where("predicted = 1")),
        "quality_rules": lambda d: ids(line_rules.judged_documents(d).where("kept")),
        "simhash_near_dedup": lambda d: sorted({r.component_id for r in simhash.near_duplicates(d).collect()}),
        "benchmark_decontamination": lambda d: sorted(
            set(ids(d)) - set(ids(decontamination.find_passages(d, benchmark)))),
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.stored(stage(spark, docs, folder), name)
        assert ids(kept) == verdicts[name](docs) and kept.columns == docs.columns
        docs = kept
    texts = {r.doc_id: r.text for r in docs.collect()}
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id: r.text for r in encoded} == {i: t.replace("▁", " ") for i, t in texts.items()}
