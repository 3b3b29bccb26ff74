"""SimHash links against all pairs, fingerprints against the definition, and the odd cases."""

import random
import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", ["", None, "one", "One two", "A b\tc\x0bd  É ß e\n", "x y z " * 400])
def test_fingerprint(text):
    assert simhash.fingerprint(simhash.shingle_hashes(text)) == slow_fingerprint(text)


def test_embedding_is_a_lower_bound():
    values = np.random.default_rng(1).integers(0, 2**63, 2000).astype(np.uint64)
    other = np.roll(values, 1) ^ np.uint64(5)
    for a, b in ((values, other), (values, values ^ np.uint64(0b1011))):
        x, y = simhash.bit_counts(a), simhash.bit_counts(b)
        expected = [sum(abs((int(p) >> 2 * k & 3) - (int(q) >> 2 * k & 3)) for k in range(32)) for p, q in zip(x, y)]
        assert simhash.manhattan(x, y).tolist() == expected
        assert (simhash.manhattan(x, y) <= np.bitwise_count(a ^ b)).all()


@pytest.mark.parametrize("part", [4096, 3])
def test_components_equal_all_pairs(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    rng = random.Random(part)
    prints = [rng.getrandbits(64) for _ in range(6)]
    for _ in range(150):  # chains around the seeds, with repeats
        p = rng.choice(prints)
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            p ^= 1 << bit
        prints.append(p)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in set(signed)], "print bigint")
    if part != 4096:  # the workers import the module anew
        rows = simhash._cells_in_order
        import pyarrow as pa
        cells = list(simhash._cell_batches([pa.RecordBatch.from_pydict({"print": sorted(set(signed))})]))
        table = pa.Table.from_batches(cells).sort_by([("choice", "ascending"), ("cell", "ascending")])
        found = pa.Table.from_batches(list(rows(table.combine_chunks().to_batches()))).to_pylist()
        links = [(r["a"], r["b"]) for r in found if r["part"] is None]
        cells = {}
        for r in found:
            if r["part"] is not None:
                cells.setdefault((r["choice"], r["cell"]), {}).setdefault(r["part"], []).append(r["a"])
        assert cells and all(len(v) <= part for c in cells.values() for v in c.values())
        for c in cells.values():
            for i in c:
                for j in range(i + 1):
                    both = [pa.table({"print": c[k], "part": [i] * len(c[k]), "other": [j] * len(c[k])}) for k in (i, j)]
                    got = simhash._two_parts(None, *both)
                    links += list(zip(got["a"].to_pylist(), got["b"].to_pylist()))
        links = spark.createDataFrame(links, "a bigint, b bigint")
    else:
        links = simhash.fingerprint_links(nodes)
    roots = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    expected = slow_components(prints)
    found = {}
    for p, e in zip(signed, expected):
        found.setdefault(roots.get(p, p), set()).add(e)
    assert all(len(v) == 1 for v in found.values()) and len(found) == len(set(expected))


def test_documents(spark):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(5, base), (3, base.upper()), (9, base + " end"), (7, "quite another text of its own"), (1, None), (2, ""),
            (3, base.upper()), (None, "alone here"), (None, base)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, print string, root int")
    found = [(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(found, key=str) == sorted(
        [(5, 3), (3, 3), (3, 3), (9, 3), (7, 7), (1, 1), (2, 1), (None, None), (None, 3)], key=str)
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 7]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 == simhash.one_per_group(docs.limit(0)).count()
