"""Token alignment against the libraries and a plain computation, and its matrices against dense ones."""

import hashlib
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import queries, token_alignment

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "a", "Hello  world\n\ttabs", "é 世界 😀 x", "a" * 3000, "say <|endoftext|> and </s> <unk> <0x41>", "x\x00y",
       "▁ mark", "   indented", "ab" * 40 + " überall", "Elle", "Elle", "   wide", "the quick brown fox " * 3000]


def slow(rows):
    tokenizer, model = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    tokenizer.encode_special_tokens = True
    alphabet = token_alignment.byte_alphabet()
    per_doc, counts = [], Counter()
    for doc, text in rows:
        want = (" " + (text or "")).encode()
        a = [(i, bytes(alphabet[c] for c in tokenizer.id_to_token(i))) for i in tokenizer.encode(want.decode(), add_special_tokens=False).ids]
        b = [(i, bytes([int(model.id_to_piece(i)[1:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode())
             for i in model.encode(text or "")]
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            per_doc.append((doc, [], [], []))
            continue
        links, ends = [], []
        for side in (a, b):
            at = np.cumsum([0] + [len(x) for _, x in side]).tolist()
            ends.append(list(zip((i for i, _ in side), at, at[1:])))
        j = 0
        for i, begin, end in ends[0]:
            while ends[1][j][2] <= begin:
                j += 1
            k = j
            while k < len(ends[1]) and ends[1][k][1] < end:
                links.append((i, ends[1][k][0]))
                k += 1
        common = sorted({e for *_, e in ends[0]} & {e for *_, e in ends[1]})
        groups, first = [], 0
        for last in common:
            groups.append([[i for i, b, e in side if first <= b and e <= last] for side in ends] if len(common) < 200 else None)
            first = last
        counts.update(links)
        per_doc.append((doc, ends, links, (common, groups)))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for doc, ends, links, grouped in per_doc:
        if not ends:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        common, groups = grouped
        if None in groups:  # long: token by token
            cut, parts = iter(common), []
            sides = [iter(s) for s in ends]
            for last in cut:
                part = []
                for side in sides:
                    ids = []
                    for i, _, e in side:
                        ids.append(i)
                        if e == last:
                            break
                    part.append(ids)
                parts.append(part)
            groups = parts
        text = ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in groups)
        out.append((doc, len(ends[0]), len(ends[1]), len(common), len(links), sum(counts[x] == best[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_equals_plain_computation(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op12_cross_tokenizer_alignment(spark, folder).select(*NAMES).collect()
    assert sorted(map(tuple, found), key=repr) == slow(rows)


def test_odd_texts(spark):
    rows = [*enumerate(ODD), (3, "a"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, block string, n_a int").repartition(3)
    found = token_alignment.aligned_documents(docs, *FILES)
    assert sorted(map(tuple, found.select(*NAMES).collect()), key=repr) == slow(rows)
    assert token_alignment.aligned_documents(docs.where("doc_id > 99"), *FILES).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_products_equal_dense_ones(seed):
    rng = np.random.default_rng(seed)
    left, right = rng.integers(0, 3, (7, 9)) * rng.integers(0, 2, (7, 9)), rng.integers(0, 3, (9, 5)) * rng.integers(0, 2, (9, 5))

    def rows(dense):
        r, c = np.nonzero(dense)
        return token_alignment.Rows(np.searchsorted(r, np.arange(len(dense) + 1)), c, dense[r, c], dense.shape[1])

    def dense(m):
        out = np.zeros((len(m.starts) - 1, m.columns), int)
        out[np.repeat(np.arange(len(out)), np.diff(m.starts)), m.indices] = m.values
        return out

    assert (dense(rows(left).times(rows(right))) == left @ right).all()
    assert (dense(rows(left).transposed()) == left.T).all()
    assert (dense(rows(left).part(2, 5)) == left[2:5]).all()


def test_links_in_slices(monkeypatch):
    encoders = token_alignment.Encoders(*FILES)
    block = encoders.block(token_alignment.pa.array(ODD))
    whole = [np.concatenate(x) for x in zip(*token_alignment.overlap_links(block))]
    shared = {tuple(p) for i, j in token_alignment.shared_group_links(block) for p in zip(i.tolist(), j.tolist())}
    assert {*zip(whole[0].tolist(), whole[1].tolist())} <= shared
    monkeypatch.setattr(token_alignment, "SLICE_BYTES", 13)
    again = [np.concatenate(x) for x in zip(*token_alignment.overlap_links(block))]
    assert all((x == y).all() for x, y in zip(whole, again))
    assert whole[2].sum() == block.a_sizes.sum()
    assert shared == {tuple(p) for i, j in token_alignment.shared_group_links(block) for p in zip(i.tolist(), j.tolist())}


def test_unknown_words_are_encoded_many_at_once(monkeypatch):
    encoders = token_alignment.Encoders(*FILES)
    given, library = [], encoders.pieces._library
    monkeypatch.setattr(encoders.pieces, "_library", lambda texts: given.extend(texts) or library(texts))
    text = "".join(f" w{n}é" for n in range(3000)) + "  two   spaces 😀 end "
    ids, _ = encoders.pieces.texts(token_alignment.pa.array([text], token_alignment.pa.large_string()))
    assert ids.tolist() == encoders.pieces.model.encode(text[1:])
    assert len(given) < 20


def test_words_of_pieces_in_every_order():
    encoders = token_alignment.Encoders(*FILES)
    rng = np.random.default_rng(5)
    marks = [*" \n\ta'é\u3000\u0085ß世x1!.<>", "  ", " the", " <unk>", "<0x41>", "</s>", "\x00", "ﬁ"]
    for _ in range(20):
        texts = [" " + "".join(rng.choice(marks, n)) for n in rng.integers(0, 30, 100)]
        ids, offsets = encoders.pieces.texts(token_alignment.pa.array(texts, token_alignment.pa.large_string()))
        for i, text in enumerate(texts):
            expected = encoders.pieces.model.encode(text[1:]) if len(text) > 1 else [encoders.pieces.model.piece_to_id("▁")]
            assert ids[offsets[i] : offsets[i + 1]].tolist() == expected, repr(text)


def test_libraries_get_few_texts_at_once_and_words_are_held_small():
    encoders = token_alignment.Encoders(*FILES)
    model, given = encoders.pieces.model, []

    class Watched:
        def encode(self, texts, **how):
            given.append(len(texts))
            return model.encode(texts, **how)

        def __getattr__(self, name):
            return getattr(model, name)

    encoders.pieces.model = Watched()
    text = "".join(f" w{n}x" for n in range(40_000))
    column = token_alignment.pa.array([text], token_alignment.pa.large_string())
    tracemalloc.start()
    try:
        found = [side.texts(column)[0] for side in (encoders.words, encoders.pieces)]
        size, held = len(text), sum(len(side.words.sizes) for side in (encoders.words, encoders.pieces))
        own = [x.nbytes for x in found]
        del found
        kept = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held >= 80_000 and max(given) <= 8 and sum(own) > size
    assert kept < 60 * held  # a dict of strings takes over 100 bytes a word
