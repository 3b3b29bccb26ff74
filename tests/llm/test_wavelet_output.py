"""Wavelet matrices against plain arrays, shard files against the tokenizer, and the odd cases."""

import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import wavelet_output as wo

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("size, top", [(0, 1), (1, 1), (1, 60000), (511, 3), (512, 50257), (5000, 50257), (3000, 2)])
def test_matrix_answers_like_an_array(size, top):
    ids = np.random.default_rng(size).integers(0, top, size).astype(np.uint32)
    matrix = wo.WaveletMatrix.from_bytes(wo.WaveletMatrix.build(ids).to_bytes())
    assert (matrix.decode() == ids).all()
    assert (matrix.access(np.arange(size)) == ids).all()
    for value in {0, 1, top - 1, top + 70000, *ids[:5].tolist()}:
        begin, end = size // 4, size - size // 5
        assert matrix.count(value) == (ids == value).sum()
        assert matrix.count(value, begin, end) == (ids[begin:end] == value).sum()
        assert matrix.positions(value).tolist() == np.flatnonzero(ids == value).tolist()


@pytest.mark.parametrize("held", [5, wo.HELD_WORDS])
def test_words_cut_off_keep_the_ids(held):
    tokenizer = Tokenizer.from_file(FILE)
    rng = np.random.default_rng(3)
    marks = [*" \n\ta'é　\u0085 ß世x1!.<>", "'s", "n't", " the", " ", *(t.content for t in tokenizer.get_added_tokens_decoder().values())]
    weight = np.array([1.0 if len(m) < 4 else 0.2 for m in marks])
    texts = ["".join(rng.choice(marks, n, p=weight / weight.sum())) for n in rng.integers(0, 40, 4000)]
    texts += ["", None, " ", "  a", "a "]
    encoder = wo.WordEncoder(tokenizer, held)
    for part in (texts[:2500], texts[2500:]):
        ids, offsets = encoder.texts(pa.array(part))
        for i, text in enumerate(part):
            expected = tokenizer.encode(text or "", add_special_tokens=False).ids + [wo.END_ID]
            assert ids[offsets[i] : offsets[i + 1]].tolist() == expected, repr(text)


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **more):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **more)

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)


def test_unknown_words_are_encoded_many_at_once():
    tokenizer = Counting(Tokenizer.from_file(FILE))
    encoder, text = wo.WordEncoder(tokenizer), "".join(f" w{n}é" for n in range(3000))
    ids, _ = encoder.texts(pa.array([text]))
    assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [wo.END_ID]
    assert tokenizer.texts < 20


def test_words_that_together_name_an_added_token():
    tokenizer = Tokenizer.from_file(FILE)
    encoder = wo.WordEncoder(tokenizer)
    for part in (["b c"], ["<|endoftext", "b|>", "<|endoftext|> x"], ["d <|endoftext|>", "e"]):
        ids, offsets = encoder.texts(pa.array(part))
        for i, text in enumerate(part):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [wo.END_ID]


def test_tasks_of_a_worker_share_the_words():
    assert wo._encoder(FILE) is wo._encoder(FILE)


def expected_rows(rows):
    tokenizer = Tokenizer.from_file(FILE)
    out, start = [], 0
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((key, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


@pytest.mark.parametrize("tokens", [7, wo.SHARD_TOKENS])
def test_files_give_every_document_back(spark, tokens):
    rows = [(None, "no id"), *((k, f"text {k} " * (k % 11)) for k in range(60)), (60, None), (61, "word " * 5000), (62, "")]
    docs = spark.createDataFrame([(*r, "x") for r in reversed(rows)], "doc_id long, text string, part string")
    found = wo.token_output(docs.repartition(5), FILE, tokens).collect()
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found), key=lambda r: r[1])
    assert got == expected_rows(rows)


def test_repeated_rows_are_written_each(spark):
    docs = spark.createDataFrame([(1, "same")] * 3 + [(1, "other")], "doc_id long, text string")
    found = sorted(r.start for r in wo.token_output(docs, FILE).collect())
    assert len(set(found)) == 4 and found[0] == 0


def test_no_documents(spark):
    assert wo.token_output(spark.createDataFrame([], "doc_id long, text string"), FILE).collect() == []
