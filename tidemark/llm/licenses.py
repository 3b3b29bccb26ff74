"""License scans: ordered signature rules over the words of a text.

Every rule is a regular expression over whole words, gated by keywords that must all occur in the
text. Rules carry a priority. A detection goes if one of at least the same priority contains its
interval (the same interval and priority: the earlier rule stays). Only built-in functions are used.

A text is lower-cased (A-Z) and split into words; each word is then written between two spaces, so
that a rule can begin and end at word limits without looking around, and the words before a place
can be counted from the spaces.

Defined cases: a missing or empty text has no words, no detections and score 0; repeated rows are
scanned each for itself; other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, split_words, whole_text

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label, keyword, identifier words, name. Every text that a name matches holds its keyword, so a name that
# can spell it in two ways is written once for each. In a name each word is a regular expression; a word
# that ends in "?" may be missing. Written in order: the more particular before the more general.
NAMES = (
    ("agpl-3.0", "affero", "agpl 3 0", "gnu affero general public license version? (v?3)? 0?"),
    ("agpl-1.0", "affero", "agpl 1 0", "affero general public license version 1 0?"),
    ("lgpl-3.0", "lesser", "lgpl 3 0", "gnu? lesser general public license version? v?3 0?"),
    ("lgpl-2.1", "lesser", "lgpl 2 1", "gnu? lesser general public license version? v?2 1"),
    ("lgpl-2.0", "library", "lgpl 2 0", "gnu? library general public license version? (v?2)? 0?"),
    ("lgpl", "lesser", "lgpl", "gnu? lesser general public license"),
    ("gpl-3.0", "gnu", "gpl 3 0", "gnu general public license version? v?3 0?"),
    ("gpl-2.0", "gnu", "gpl 2 0", "gnu general public license version? v?2 0?"),
    ("gpl-1.0", "gnu", "gpl 1 0", "gnu general public license version? v?1 0?"),
    ("gpl-any", "gnu", "gpl", "gnu general public license as published by the free software foundation"),
    ("gfdl-1.3", "gnu", "gfdl 1 3", "gnu free documentation license version? v?1 3"),
    ("gfdl-1.2", "gnu", "gfdl 1 2", "gnu free documentation license version? v?1 2"),
    ("gfdl", "gnu", "gfdl", "gnu free documentation license"),
    ("apache-2.0", "apache", "apache 2 0", "apache license version? v?2 0?"),
    ("apache-1.1", "apache", "apache 1 1", "apache software? license version? v?1 1"),
    ("apache-1.0", "apache", "apache 1 0", "apache software? license version? v?1 0"),
    ("bsd-4-clause", "bsd", "bsd 4 clause", "(4|four|original) clause? bsd license"),
    ("bsd-3-clause", "bsd", "bsd 3 clause", "(3|three|new|revised|modified) clause? bsd license"),
    ("bsd-2-clause", "bsd", "bsd 2 clause", "(2|two|simplified|freebsd) clause? bsd license"),
    ("0bsd", "bsd", "0bsd", "(0|zero) clause? bsd license"),
    ("bsd", "bsd", "bsd", "bsd license"),
    ("mit-0", "mit", "mit 0", "mit no attribution license?"),
    ("mit-expat", "expat", "expat", "expat mit? license"),
    ("mit", "mit", "mit", "mit x11? license"),
    ("x11", "x11", "x11", "x11 license"),
    ("isc", "isc", "isc", "isc license"),
    ("zlib", "zlib", "zlib", "zlib libpng? license"),
    ("libpng", "libpng", "libpng", "libpng license version? 2?"),
    ("mpl-2.0", "mozilla", "mpl 2 0", "mozilla public license version? v?2 0?"),
    ("mpl-1.1", "mozilla", "mpl 1 1", "mozilla public license version? v?1 1"),
    ("mpl-1.0", "mozilla", "mpl 1 0", "mozilla public license version? v?1 0?"),
    ("mpl", "mozilla", "mpl", "mozilla public license"),
    ("epl-2.0", "eclipse", "epl 2 0", "eclipse public license version? v?2 0?"),
    ("epl-1.0", "eclipse", "epl 1 0", "eclipse public license version? v?1 0?"),
    ("edl-1.0", "eclipse", "edl 1 0", "eclipse distribution license version? (v?1)? 0?"),
    ("cddl-1.1", "cddl", "cddl 1 1", "common development and distribution license cddl version? 1 1"),
    ("cddl-1.0", "distribution", "cddl 1 0", "common development and distribution license version? 1? 0?"),
    ("cpl-1.0", "common", "cpl 1 0", "common public license version? (v?1)? 0?"),
    ("eupl-1.2", "european", "eupl 1 2", "european union public licen[cs]e version? v?1 2"),
    ("eupl-1.1", "european", "eupl 1 1", "european union public licen[cs]e version? v?1 1"),
    ("bsl-1.0", "boost", "bsl 1 0", "boost software license version? (v?1)? 0?"),
    ("busl-1.1", "business", "busl 1 1", "business source license version? (v?1)? 1?"),
    ("sspl-1.0", "server", "sspl 1 0", "server side public license version? (v?1)?"),
    ("elastic-2.0", "elastic", "elastic 2 0", "elastic license version? v?2 0?"),
    ("artistic-2.0", "artistic", "artistic 2 0", "artistic license version? v?2 0?"),
    ("artistic-1.0", "artistic", "artistic 1 0", "artistic license version? (v?1)? 0?"),
    ("psf-2.0", "python", "psf 2 0", "python software foundation license version? (v?2)?"),
    ("php-3.01", "php", "php 3 01", "php license version? (v?3)? 01?"),
    ("ruby", "ruby", "ruby", "ruby license"),
    ("perl", "perl", "perl", "same terms as perl itself"),
    ("w3c", "w3c", "w3c", "w3c software notice and? license"),
    ("ofl-1.1", "sil", "ofl 1 1", "sil open font license version? (v?1)? 1?"),
    ("ncsa", "ncsa", "ncsa", "ncsa open source license"),
    ("openssl", "openssl", "openssl", "openssl license"),
    ("curl", "curl", "curl", "curl license"),
    ("postgresql", "postgresql", "postgresql", "postgresql licen[cs]e"),
    ("unlicense", "unlicense", "unlicense", "the unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl license? version? 2?"),
    ("beerware", "beerware", "beerware", "beerware license"),
    ("ms-pl", "microsoft", "ms pl", "microsoft public license"),
    ("ms-rl", "microsoft", "ms rl", "microsoft reciprocal license"),
    ("odbl-1.0", "database", "odbl 1 0", "open database license version? (v?1)? 0?"),
    ("odc-by-1.0", "odc", "odc by 1 0", "odc attribution license version? (v?1)? 0?"),
    ("pddl-1.0", "dedication", "pddl 1 0", "public domain dedication and license version? (v?1)? 0?"),
    ("cc0-1.0", "cc0", "cc0 1 0", "cc0 1? 0? universal?"),
    ("cc-by-nc-nd-4.0", "nd", "cc by nc nd 4 0", "creative? (cc|commons) (by|attribution) (nc|noncommercial) nd version? v?4 0"),
    ("cc-by-nc-nd-4.0", "noderivatives", "cc by nc nd 4 0", "creative? (cc|commons) (by|attribution) (nc|noncommercial) noderivatives version? v?4 0"),
    ("cc-by-nc-nd", "nd", "cc by nc nd", "creative? (cc|commons) (by|attribution) (nc|noncommercial) nd"),
    ("cc-by-nc-nd", "noderivatives", "cc by nc nd", "creative? (cc|commons) (by|attribution) (nc|noncommercial) noderivatives"),
    ("cc-by-nc-sa-4.0", "sa", "cc by nc sa 4 0", "creative? (cc|commons) (by|attribution) (nc|noncommercial) sa version? v?4 0"),
    ("cc-by-nc-sa-4.0", "sharealike", "cc by nc sa 4 0", "creative? (cc|commons) (by|attribution) (nc|noncommercial) sharealike version? v?4 0"),
    ("cc-by-nc-sa", "sa", "cc by nc sa", "creative? (cc|commons) (by|attribution) (nc|noncommercial) sa"),
    ("cc-by-nc-sa", "sharealike", "cc by nc sa", "creative? (cc|commons) (by|attribution) (nc|noncommercial) sharealike"),
    ("cc-by-nc-4.0", "nc", "cc by nc 4 0", "creative? (cc|commons) (by|attribution) nc version? v?4 0"),
    ("cc-by-nc-4.0", "noncommercial", "cc by nc 4 0", "creative? (cc|commons) (by|attribution) noncommercial version? v?4 0"),
    ("cc-by-nc", "nc", "cc by nc", "creative? (cc|commons) (by|attribution) nc"),
    ("cc-by-nc", "noncommercial", "cc by nc", "creative? (cc|commons) (by|attribution) noncommercial"),
    ("cc-by-sa-4.0", "sa", "cc by sa 4 0", "creative? (cc|commons) (by|attribution) sa version? v?4 0"),
    ("cc-by-sa-4.0", "sharealike", "cc by sa 4 0", "creative? (cc|commons) (by|attribution) sharealike version? v?4 0"),
    ("cc-by-sa-3.0", "sa", "cc by sa 3 0", "creative? (cc|commons) (by|attribution) sa version? v?3 0"),
    ("cc-by-sa-3.0", "sharealike", "cc by sa 3 0", "creative? (cc|commons) (by|attribution) sharealike version? v?3 0"),
    ("cc-by-sa", "sa", "cc by sa", "creative? (cc|commons) (by|attribution) sa"),
    ("cc-by-sa", "sharealike", "cc by sa", "creative? (cc|commons) (by|attribution) sharealike"),
    ("cc-by-nd-4.0", "nd", "cc by nd 4 0", "creative? (cc|commons) (by|attribution) nd version? v?4 0"),
    ("cc-by-nd-4.0", "noderivatives", "cc by nd 4 0", "creative? (cc|commons) (by|attribution) noderivatives version? v?4 0"),
    ("cc-by-nd", "nd", "cc by nd", "creative? (cc|commons) (by|attribution) nd"),
    ("cc-by-nd", "noderivatives", "cc by nd", "creative? (cc|commons) (by|attribution) noderivatives"),
    ("cc-by-4.0", "by", "cc by 4 0", "cc by version? v?4 0"),
    ("cc-by-3.0", "by", "cc by 3 0", "cc by version? v?3 0"),
    ("cc-by-2.0", "by", "cc by 2 0", "cc by version? v?2 0"),
    ("cc-by-4.0", "creative", "cc by 4 0 international", "creative commons attribution version? 4 0 international? public? license?"),
    ("public-domain", "domain", "public domain", "(in|into|to) the public domain"),
    ("proprietary", "reserved", "proprietary", "all rights reserved"),
)

GRANT = (
    "(licensed|released|distributed|available|redistributed|provided|published|covered|made) "
    "available? under the? terms? conditions? of? the? a?"
)
BASE_PRIORITY, NAME_PRIORITY, GRANT_PRIORITY, IDENTIFIER_PRIORITY = 1, 2, 3, 4
CONFIDENCE = {BASE_PRIORITY: 0.5, NAME_PRIORITY: 0.7, GRANT_PRIORITY: 0.9, IDENTIFIER_PRIORITY: 1.0}


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    priority: int
    keywords: tuple[str, ...]
    pattern: str
    base: bool


def word_pattern(words: str) -> str:
    """A regular expression over words, as one over the text in which each word stands in spaces."""
    parts = []
    for word in words.split(" "):
        parts.append(f"(?: {word[:-1]} )?" if word.endswith("?") else f" {word} ")
    return "".join(parts)


def signature_rules() -> list[Rule]:
    """Base phrases, then every name alone, in a grant and as an identifier."""
    rules: list[Rule] = []

    def add(label: str, priority: int, keywords: list[str], words: str, base: bool = False) -> None:
        rules.append(Rule(len(rules), label, priority, tuple(dict.fromkeys(keywords)), word_pattern(words), base))

    for phrase, label in BASE.items():
        add(label, BASE_PRIORITY, phrase.split(), phrase, base=True)
    for label, keyword, _, name in NAMES:
        add(label, NAME_PRIORITY, [keyword], name)
    for label, keyword, _, name in NAMES:
        add(label, GRANT_PRIORITY, [keyword, "under"], f"{GRANT} {name}")
    for label, identifier in dict.fromkeys((n[0], n[2]) for n in NAMES):
        add(label, IDENTIFIER_PRIORITY, ["spdx", identifier.split()[0]], f"spdx license identifier {identifier}")
    return rules


RULES = signature_rules()


def _rule_array(rules: list[Rule]) -> Column:
    return F.array(*(
        F.struct(
            F.lit(r.number).alias("number"),
            F.array(*map(F.lit, r.keywords)).alias("keywords"),
            F.lit(r.pattern).alias("pattern"),
        ) for r in rules))


def _pick(rules: list[Rule], value) -> Column:
    """A property of the rule whose number is in column ``rule``."""
    return F.get(F.array(*(F.lit(value(r)) for r in rules)), F.col("rule"))


def _words_in(spaced: Column) -> Column:
    """Each word brings two spaces."""
    return F.floor((F.length(spaced) - F.length(F.replace(spaced, F.lit(" ")))) / 2).cast("long")


def detections(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Every place where a rule matches: (row, doc_id, n_words, rule, first, last), words from 0.

    A document without one has a row without a rule. ``row`` tells repeated documents apart.
    """
    rules = RULES if rules is None else rules
    keywords = sorted({k for r in rules for k in r.keywords})
    words = split_words(lower_ascii(whole_text("text")), SEPARATOR)
    split = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words.alias("words"))
    gated = split.select(
        "row", "doc_id", F.size("words").cast("long").alias("n_words"), "words",
        F.array_intersect("words", F.array(*map(F.lit, keywords))).alias("found"),
    )
    spaced = F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" "))
    passing = gated.select(
        "row", "doc_id", "n_words",
        F.when(F.size("found") > 0, spaced).alias("spaced"),
        F.filter(
            F.when(F.size("found") > 0, _rule_array(rules)),
            lambda r: F.size(F.array_except(r["keywords"], F.col("found"))) == 0,
        ).alias("candidates"),
    )
    # What lies between and in the matches of a rule, in words: their running sums are the places.
    hits = passing.select(
        "row", "doc_id", "n_words",
        F.filter(
            F.transform(
                "candidates",
                lambda r: F.struct(
                    r["number"].alias("rule"),
                    F.transform(F.split(F.col("spaced"), r["pattern"], -1), _words_in).alias("between"),
                    F.transform(F.regexp_extract_all(F.col("spaced"), r["pattern"], F.lit(0)), _words_in).alias("inside"),
                ),
            ),
            lambda h: F.size(h["inside"]) > 0,
        ).alias("hits"),
    )
    each = hits.select("row", "doc_id", "n_words", F.explode_outer("hits").alias("h")).select(
        "row", "doc_id", "n_words", F.col("h.rule").alias("rule"),
        F.posexplode_outer(F.arrays_zip(
            F.slice("h.between", 1, F.size("h.inside")).alias("between"), F.col("h.inside").alias("inside"))),
    ).repartition("row")  # all that follows is per row
    running = W.partitionBy("row", "rule").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("col.between") + F.col("col.inside")).over(running)
    return each.select(
        "row", "doc_id", "n_words", "rule", (end - F.col("col.inside")).alias("first"), (end - 1).alias("last"))


def surviving(found: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Adds ``stays``: whether no detection of at least the same priority contains this one.

    Ordered by first word, longest first, highest priority first and rule, whatever contains a
    detection comes before it; the furthest last word so far, per priority, then decides.
    """
    rules = RULES if rules is None else rules
    ranked = found.withColumn("priority", _pick(rules, lambda r: r.priority))
    before = (
        W.partitionBy("row").orderBy("first", F.desc("last"), F.desc("priority"), "rule")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    contained = F.lit(False)
    for p in sorted({r.priority for r in rules}):
        reach = F.max(F.when(F.col("priority") >= p, F.col("last"))).over(before)
        contained = contained | ((F.col("priority") == p) & F.coalesce(reach >= F.col("last"), F.lit(False)))
    return ranked.withColumn("stays", F.col("rule").isNotNull() & ~contained)


def scan_licenses(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per document: base places, labels of base and surviving detections, spans, score."""
    rules = RULES if rules is None else rules
    judged = surviving(detections(docs, rules), rules).withColumns({
        "base": F.coalesce(_pick(rules, lambda r: r.base), F.lit(False)),
        "label": _pick(rules, lambda r: r.label),
        "confidence": _pick(rules, lambda r: CONFIDENCE[r.priority]),
    })
    base, stays = F.col("base"), F.col("stays")
    span = F.struct("first", "last", "label", "rule")
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    return judged.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        joined(F.collect_set(F.when(base | stays, F.col("label")))).alias("labels"),
        F.coalesce(F.max(F.when(base | stays, F.col("confidence"))), F.lit(0.0)).alias("score"),
        F.count_if(stays).alias("n_detections"),
        F.array_sort(F.collect_list(F.when(stays, span))).alias("spans"),
    ).drop("row")
