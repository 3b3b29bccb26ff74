"""URL rules by hand, reputation against a plain computation, and the query against its SQL."""

from collections import Counter

import pytest
from compare import connect

from tidemark.llm import url_reputation as ur
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES

CASES = [
    ("https://a.example.org/es/1", "a.example.org", "/es/1", "example.org/es/", "block"),
    ("https://EXAMPLE.org/en/17?x=1", "example.org", "/en/17", "example.org/en/1", "block"),
    ("https://example.org/en/2#t", "example.org", "/en/2", "org/", "allow"),
    ("https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"),
    ("http://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
    ("http://x.com/DE/1", "x.com", "/DE/1", None, "allow"),
    ("http://example.org", "example.org", "", None, "allow"),
    ("http://x.net?u=http://y.org/es/", "x.net", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
]


def test_rules(spark):
    pages = spark.createDataFrame([(i, c[0], "<p>", "mine") for i, c in enumerate(CASES)], "page_id long, url string, html string, host string")
    found = ur.judged_pages(pages).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in found] == [c[1:] for c in CASES]


def slow_posteriors(hosts):
    """Host to (rate, bound), level by level."""
    def strength(groups):
        seen = sum((k - n * m) ** 2 for n, k, m in groups)
        base = sum(n * m * (1 - m) for n, _, m in groups)
        pairs = sum(n * (n - 1) * m * (1 - m) for n, _, m in groups)
        rho = (seen - base) / pairs if pairs else 0.01
        return 1 / min(max(rho, 0.01), 0.9) - 1

    def total(keys):
        out = {}
        for key, (n, k) in zip(keys, hosts.values()):
            a, b = out.get(key, (0, 0))
            out[key] = a + n, b + k
        return out

    tail = lambda h, parts: ".".join(h.split(".")[-parts:])
    every, bad = sum(n for n, _ in hosts.values()), sum(k for _, k in hosts.values())
    mean = {"": (bad + 1) / (every + 2)}
    for parts in (1, 2, 99):
        level = total([tail(h, parts) for h in hosts])
        prior = {g: mean["" if parts == 1 else tail(g, 1 if parts == 2 else 2)] for g in level}
        s = strength([(*level[g], prior[g]) for g in level])
        mean = {g: (k + s * prior[g]) / (n + s) for g, (n, k) in level.items()}
    return {h: (m, m - ur.Z * (m * (1 - m) / (hosts[h][0] + s + 1)) ** 0.5) for h, m in mean.items()}


def test_reputation(spark):
    hosts = {"a.x.com": (40, 38), "b.x.com": (0, 0), "y.com": (30, 1), "a.z.net": (9, 9), "b.z.net": (0, 0), "q.net": (12, 2)}
    df = spark.createDataFrame([(h, *v) for h, v in hosts.items()], "host string, n long, bad long")
    found = {r.host: (r.rate, r.bound) for r in ur.host_reputation(df).collect()}
    expected = slow_posteriors(hosts)
    assert found.keys() == expected.keys()
    for host, values in expected.items():
        assert found[host] == pytest.approx(values)
    assert found["a.x.com"][1] >= ur.MAX_BAD > found["y.com"][1]
    assert found["b.x.com"][0] > found["q.net"][0]  # an unseen host takes after its domain


def test_registered_domains(spark):
    df = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("a.b.c.org",), ("org",), ("",)], "host string")
    found = {r.host: (r.domain, r.suffix) for r in ur.with_levels(df).collect()}
    assert found == {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"), "a.b.c.org": ("c.org", "org"),
                     "org": ("org", "org"), "": ("", "")}


def test_ports_users_and_addresses(spark):
    hosts = ["a.b.co.uk:8080", "me@x.example.org.", "10.0.0.7", "10.0.0.7:81", "[::1]:80", "co.uk", "", "x:y@host"]
    found = {r.host: (r.domain, r.suffix) for r in ur.with_levels(spark.createDataFrame([(h,) for h in hosts], "host string")).collect()}
    assert found == {
        "a.b.co.uk:8080": ("b.co.uk", "co.uk"), "me@x.example.org.": ("example.org", "org"), "10.0.0.7": ("10.0.0.7",) * 2,
        "10.0.0.7:81": ("10.0.0.7",) * 2, "[::1]:80": ("[::1]",) * 2, "co.uk": ("co.uk", "uk"), "": ("", ""), "x:y@host": ("host", "host")}


def test_pages_without_a_rule_go_by_their_host(spark):
    rows = [(i, f"http://bad.com/de/{i}") for i in range(40)] + [(99, "http://bad.com/en/1"), (98, "http://new.net/")]
    rows += [(100 + i, f"http://h{i}.good{i % 7}.org/en/{i}") for i in range(60)]
    found = {r.page_id: r.verdict for r in ur.judged_pages(spark.createDataFrame(rows + rows, "page_id long, url string")).collect()}
    assert (found[99], found[98]) == ("block", "allow")


def test_no_pages(spark):
    assert ur.judged_pages(spark.createDataFrame([], "page_id long, url string")).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    found = QUERIES[name](spark, folder)
    expected = connect(folder).execute(f"SELECT {', '.join(found.columns)} FROM ({ORACLE[name]})").fetchall()
    assert Counter(map(tuple, found.collect())) == Counter(expected)
