"""Token counts, SentencePiece and the line field against brute force, and the pipeline whole."""

import base64

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from tidemark.llm import quality_crf, sentencepiece_viterbi, token_counts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", None, " ", "one", "Hello  world\n\ttabs", "é 世界 😀 x", "a" * 3000, "the quick brown fox " * 200, "x\x00y"]


def greedy(pieces, longest, word):
    at, count = 0, 0
    while at < len(word):
        size = next(k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in pieces)
        at, count = at + size, count + 1
    return count


def test_token_counts_are_greedy(spark):
    pieces = set(token_counts.read_vocabulary(VOCABULARY))
    longest = max(map(len, pieces))
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS * 2)], "doc_id long, text string, n_tokens string")
    found = {}
    for r in token_counts.token_counts(docs, VOCABULARY).collect():
        found[r.doc_id] = (r.n_bytes, r.n_words, r.n_tokens)
    for i, text in enumerate(TEXTS * 2):
        words = (text or "").encode().split()
        assert found[i] == (len((text or "").encode()), len(words), sum(greedy(pieces, longest, b" " + w) for w in words))


def test_a_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError):
        token_counts.build_automaton([b"a", base64.b64decode("YWI=")])


def slow_viterbi(scores, word):
    """The best sum of scores over all ways to cut a word into pieces."""
    best = [0.0] + [-np.inf] * len(word)
    for end in range(1, len(word) + 1):
        for begin in range(end):
            score = scores.get(word[begin:end])
            if score is not None:
                best[end] = max(best[end], best[begin] + score)
    return best[-1]


def test_segmentation_has_the_best_score(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    scores = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
              if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    words = ["hello", "internationalisation", "a", "zzzzzz", "Tokenizer", "überall", "x1y2z3"]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    for r in sentencepiece_viterbi.encode(docs, MODEL).collect():
        text = "▁" + words[r.doc_id]
        assert "".join(model.id_to_piece(i) for i in r.ids) == text
        assert sum(model.get_score(i) for i in r.ids) == pytest.approx(slow_viterbi(scores, text))


def test_encoding_is_undone(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    encoded = sentencepiece_viterbi.encode(docs, MODEL)
    found = {r.doc_id: r.text for r in sentencepiece_viterbi.decode(encoded, MODEL).collect()}
    assert found == {i: t or "" for i, t in enumerate(TEXTS)}
    assert all(r.restored for r in sentencepiece_viterbi.round_trip(docs, MODEL).collect())


def test_chain_marginals_are_exact():
    rng = np.random.default_rng(5)
    for n in (1, 2, 5):
        unary, stay = rng.normal(size=n), rng.normal(size=2)
        total, good = 0.0, np.zeros(n)
        for code in range(1 << n):
            labels = [(code >> i) & 1 for i in range(n)]
            score = sum(u for u, y in zip(unary, labels) if y) + sum(stay[a] for a, b in zip(labels, labels[1:]) if a == b)
            total += np.exp(score)
            good += np.exp(score) * np.array(labels)
        prob, _, _, norm = quality_crf.chain(unary, np.zeros(n, np.int64), stay)
        assert prob == pytest.approx(good / total)
        assert norm == pytest.approx(np.log(total))


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = quality_crf.document_quality(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    judged = found.where("held_out").join(labels.where("quality IS NOT NULL"), "doc_id").collect()
    assert len(judged) > 50
    assert sum(r.predicted == r.quality for r in judged) >= 0.95 * len(judged)


def test_quality_without_labels_or_documents(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    assert {r.score for r in quality_crf.document_quality(docs, labels).collect()} == {0.5}
    assert quality_crf.document_quality(docs.where("doc_id < 0"), labels).collect() == []


def test_pipeline_keeps_the_columns_of_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.count() == before
