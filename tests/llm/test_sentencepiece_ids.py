"""SentencePiece ids of the query and of the pipeline's stage against the library's own encoder."""

import random
import zlib

import numpy as np
import public_tokenizers
import sentencepiece

import corpus_pipeline
from tidemark.llm import queries, sentencepiece_viterbi

MODEL = public_tokenizers.path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"
ODD = ["", None, " ", "Elle", "hello  world\n\ttabs", "é 世界 😀 x", "a" * 3000, "aaaaaaaa", "x\x00y", "   indented",
       "internationalisation überall", "ab" * 40 + " " + "Wort" * 13, "国際連合は世界" * 20, "________________", "c▁d ▁▁ e"]


def test_ids_are_the_librarys(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    found = corpus_pipeline.sentencepiece(spark, docs, "").collect()
    assert {r.doc_id: list(r.ids) for r in found} == {i: library.encode(t or "") for i, t in enumerate(ODD)}
    assert {r.doc_id: r.text for r in found} == {i: (t or "").replace("▁", " ") for i, t in enumerate(ODD)}


def test_query_on_documents(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    expected = {}
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "")
        expected.setdefault(r.doc_id, set()).add((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    found = {}
    for r in queries.op4_sentencepiece(spark, FOLDER).collect():
        found.setdefault(r.doc_id, set()).add((r.n_pieces, r.ids_crc32))
        assert r.restored
    assert found == expected


def test_heap_and_matrix_agree(monkeypatch):
    model = sentencepiece_viterbi.load_pieces(MODEL)
    texts = [t for t in ODD if t]
    ids, _ = sentencepiece_viterbi.encode_texts(model, texts, sentencepiece_viterbi.merges)
    monkeypatch.setattr(sentencepiece_viterbi, "LONG_WORD", 0)
    again, _ = sentencepiece_viterbi.encode_texts(model, texts, sentencepiece_viterbi.merges)
    assert ids.tolist() == again.tolist()


def test_the_search_gives_the_merges(monkeypatch):
    """Words of the documents, glued ones, and odd runs: the batched search, the lone one and the merges agree."""
    model = sentencepiece_viterbi.load_pieces(MODEL)
    rng = random.Random(4)
    names = [n for n in model.names if "<" not in n]
    texts = ["".join(rng.choices(names, k=rng.randint(1, 6))).replace("▁", "") for _ in range(3000)]
    texts += ["".join(rng.choices("ab_1.é", k=rng.randint(1, 60))) for _ in range(1000)] + [t for t in ODD if t]
    found, _ = sentencepiece_viterbi.encode_texts(model, texts, sentencepiece_viterbi.ranked_viterbi)
    expected, _ = sentencepiece_viterbi.encode_texts(model, texts, sentencepiece_viterbi.merges)
    assert found.tolist() == expected.tolist()
    monkeypatch.setattr(sentencepiece_viterbi, "LONG_WORD", 0)
    again, _ = sentencepiece_viterbi.encode_texts(model, texts[::7], sentencepiece_viterbi.ranked_viterbi)
    expected, _ = sentencepiece_viterbi.encode_texts(model, texts[::7], sentencepiece_viterbi.merges)
    assert again.tolist() == expected.tolist()


def test_forgotten_steps_are_found_again(monkeypatch):
    monkeypatch.setattr(sentencepiece_viterbi, "HELD_STEPS", 3)
    model = sentencepiece_viterbi.load_pieces(MODEL)
    found, offsets = sentencepiece_viterbi.encode_texts(model, ODD, sentencepiece_viterbi.ranked_viterbi)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert [found[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library.encode(t or "") for t in ODD]


def test_odd_tables(spark):
    rows = [(1, "one two", 5, "x"), (1, "one two", 5, "x"), (None, None, 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_pieces int, ids string")
    cut = sentencepiece_viterbi.ranked_viterbi
    found = sorted((r.doc_id or 0, r.n_pieces, r.text) for r in sentencepiece_viterbi.encode_and_decode(docs, MODEL, cut).collect())
    assert found[0] == (0, 0, "") and found[1] == found[2] and found[1][2] == "one two"
    assert sentencepiece_viterbi.encode_and_decode(docs.where("doc_id > 9"), MODEL, cut).collect() == []
