"""Line-first cleaning: rules judge every line, failing lines go, documents that lose too much go.

All rules are built-in expressions over the array of a document's lines; nothing is shuffled.

Defined cases: a missing text is an empty one and fails the base rule; repeated rows are judged
alike, each for itself; other columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_RUN, SPACES, split_words, whole_text

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
SYMBOLS = "#*$%&|<>"

# A line fails if it matches one of these.
# Repetition is written out: a repeated group would recurse once per round on a long line.
SEPARATORS = r"[|»›·•][^|»›·•]*[|»›·•][^|»›·•]*[|»›·•]"  # navigation: three or more menu separators
SHOUTS = r"!!+[^!]+!!+"  # punctuation: two or more runs of exclamation marks
RULERS = r"[.?,;:_=~-]{4}.*[.?,;:_=~-]{4}.*[.?,;:_=~-]{4}"  # punctuation: three or more rulers
BOILERPLATE = (
    r"(?i)\b(?:all rights reserved|cookie policy|privacy policy|terms of (?:use|service)|accept (?:all )?cookies|"
    r"enable javascript|javascript is (?:disabled|required)|click here|read more|sign up|log ?in to|"
    r"subscribe to our|share (?:this|on)|skip to (?:main )?content|back to top|lorem ipsum)\b"
)
MAX_SYMBOL_PERCENT = 10  # punctuation: symbols among the characters of a line
BOILERPLATE_CHARS = 100  # a longer line that mentions such a phrase is prose
MIN_KEPT_PERCENT = 50  # a document must keep at least this share of its visible characters


def without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c))
    return text


def symbols(text: Column) -> Column:
    return F.length(text) - F.length(without(text, SYMBOLS))


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def line_fails(line: Column) -> Column:
    """Punctuation, navigation and boilerplate rules for a line that has a word."""
    return (
        (symbols(line) * 100 > F.length(line) * MAX_SYMBOL_PERCENT)
        | line.rlike(SHOUTS)
        | line.rlike(RULERS)
        | line.rlike(SEPARATORS)
        | ((F.length(line) <= BOILERPLATE_CHARS) & line.rlike(BOILERPLATE))
    )


def judged_documents(docs: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """One row per document: its base measures, its cleaned text and whether it stays.

    Columns named in ``carried`` come along in a struct of that name.
    """
    text = whole_text("text")
    along = ["carried"] if carried else []
    row = [F.struct(*(c for c in carried if c != "text")).alias("carried")] if carried else []
    words = docs.select("doc_id", *row, text.alias("text"), split_words(text, SPACE_RUN, SPACES).alias("words"))
    measured = words.select(
        "doc_id",
        *along,
        "text",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        symbols(F.col("text")).cast("long").alias("n_symbols"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - WINDOW),
                lambda i: F.xxhash64(*(F.get(F.col("words"), i + k) for k in range(WINDOW))),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("grams"),
        F.filter(F.split("text", "\n", -1), has_word).alias("lines"),
    )
    # Sorting (hash, position) brings equal windows together; the positions of those with an equal
    # neighbour, sorted again, cover WINDOW words each, less where the next one begins earlier.
    repeated = F.size(F.array_distinct("grams")) < F.size("grams")
    pairs = F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    ordered = measured.withColumn("ordered", F.when(repeated, F.sort_array(pairs)))
    again = ordered.withColumn(
        "again",
        F.sort_array(
            F.transform(
                F.filter(
                    "ordered",
                    lambda x, k: (F.get(F.col("ordered"), k - 1)["g"] == x["g"])
                    | (F.get(F.col("ordered"), k + 1)["g"] == x["g"]),
                ),
                lambda x: x["i"],
            )
        ),
    )
    spans = F.transform(
        "again",
        lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("again"), k + 1) - p, F.lit(WINDOW))),
    )
    covered = again.select(
        "doc_id", *along, "text", "n_words", "word_chars", "n_symbols", "lines",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(spans, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    split = covered.withColumn("failed_lines", F.filter("lines", line_fails))
    failed_chars = F.length(without(F.array_join("failed_lines", ""), SPACES))
    kept_chars = F.col("word_chars") - failed_chars
    verdict = split.select(
        "doc_id", *along, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        F.size("failed_lines").cast("long").alias("n_failed_lines"),
        kept_chars.cast("long").alias("kept_chars"),
        F.when(F.size("failed_lines") == 0, F.col("text"))
        .otherwise(F.array_join(F.filter(F.split("text", "\n", -1), lambda x: ~(has_word(x) & line_fails(x))), "\n"))
        .alias("clean_text"),
        (~base_failed & (kept_chars * 100 >= F.col("word_chars") * MIN_KEPT_PERCENT)).alias("kept"),
    )
    # A generator, since a filter on the result would otherwise be pushed down through all these
    # projections, its columns written out in it, and the arrays computed once per element.
    return verdict.select(F.inline(F.array(F.struct("*"))))


def cleaned_documents(docs: DataFrame) -> DataFrame:
    """The documents that stay, in their own columns, with only the failed lines taken out of the text.

    Blank lines stay, and a text without a failed line comes back as it is.
    """
    clean = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return (
        judged_documents(docs, carried=docs.columns)
        .where("kept")
        .select(*(
            clean[c].cast(kind).alias(c) if c in clean else F.col("carried")[c].alias(c) for c, kind in docs.dtypes))
    )
