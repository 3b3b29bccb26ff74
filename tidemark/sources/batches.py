"""Tables that grow by published batches: staged, counted while they are written, then published or not.

A batch is written under ``data/batch=<id>``, where nobody looks. It becomes visible when its rows enter the
``ledger``, one file that the file system renames into place. A job that is killed before that leaves nothing
that a reader sees, and its rerun writes a batch of its own. The ledger also names the source files a batch
was made from, so that the same files are not taken twice. One writer per table is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F

from tidemark.functions import clustered
from tidemark.sources.tables import DEFAULT_FORMAT, table_exists, writer

LEDGER = (
    "batch string, seq bigint, replaces boolean, rows bigint, published_at timestamp, "
    "source_file string, file_size bigint, modified timestamp"
)
ROWS = "rows"  # the counter every batch has


class Refused(Exception):
    """A staged batch that its gate does not let through; its rows stay unpublished."""

    def __init__(self, reasons: Sequence[str], batch: str, counts: Mapping[str, object]) -> None:
        super().__init__(f"batch {batch}: " + "; ".join(reasons))
        self.reasons, self.batch, self.counts = list(reasons), batch, dict(counts)


@dataclass(frozen=True)
class Batch:
    """``counts`` were collected by the job that wrote the batch."""

    batch: str
    counts: dict[str, object] = field(default_factory=dict)


def _data(path: str) -> str:
    return f"{path.rstrip('/')}/data"


def _ledger(path: str) -> str:
    return f"{path.rstrip('/')}/ledger"


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """What has been published: a row per batch and source file; empty for a table not begun yet."""
    if not table_exists(spark, _ledger(path)):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(_ledger(path))


def _published(spark: SparkSession, path: str) -> list[Row]:
    """(batch, seq, rows), in order, from the last replacing batch on: one row per run, fetched."""
    runs = ledger(spark, path).groupBy("batch").agg(
        F.max("seq").alias("seq"), F.max("replaces").alias("replaces"), F.max("rows").alias("rows"))
    rows = sorted(runs.collect(), key=lambda r: r["seq"])
    first = max((i for i, r in enumerate(rows) if r["replaces"]), default=0)
    return rows[first:]


def counted(
    df: DataFrame, by: Sequence[str], counters: Mapping[str, Column], together: bool = False
) -> tuple[DataFrame, Observation]:
    """The rows as a batch writes them, and the observation that counts them on the way.

    The counters stand above the shuffle, in the writing stage: a task that is run again counts once.
    ``together``: the rows lie together by partition already.
    """
    observation = Observation()
    rows = clustered(df, by) if by and not together else df
    every = {ROWS: F.count(F.lit(1)), **counters}
    return rows.observe(observation, *[c.alias(name) for name, c in every.items()]), observation


def stage(
    df: DataFrame,
    path: str,
    by: Sequence[str] = (),
    counters: Mapping[str, Column] | None = None,
    fmt: str = DEFAULT_FORMAT,
    together: bool = False,
) -> Batch:
    """Write a batch without publishing it; one pass over the input gives the counts as well."""
    batch = f"b{uuid.uuid4().hex}"
    rows, observation = counted(df, by, counters or {}, together)
    writer(rows, fmt).partitionBy(*by).save(f"{_data(path)}/batch={batch}")
    return Batch(batch, dict(observation.get))


def publish(
    spark: SparkSession, path: str, staged: Batch, sources: Sequence[Row] = (), replaces: bool = False
) -> Batch:
    """Make a staged batch visible, after or (``replaces``) instead of all published before."""
    last = _published(spark, path)
    seq = last[-1]["seq"] + 1 if last else 0
    head = (staged.batch, seq, replaces, staged.counts[ROWS], datetime.now(timezone.utc))
    named = [(*head, s["source_file"], s["file_size"], s["modified"]) for s in sources] or [(*head, None, None, None)]
    # One file: the rename that commits it shows the whole batch.
    spark.createDataFrame(named, LEDGER).coalesce(1).write.mode("append").parquet(_ledger(path))
    return staged


def add_batch(
    df: DataFrame,
    path: str,
    by: Sequence[str] = (),
    counters: Mapping[str, Column] | None = None,
    refusals: Callable[[Mapping[str, object]], Sequence[str]] | None = None,
    sources: Sequence[Row] = (),
    replaces: bool = False,
    fmt: str = DEFAULT_FORMAT,
    together: bool = False,
) -> Batch:
    """Stage a batch and publish it if ``refusals`` of its counts names none; otherwise raise ``Refused``."""
    staged = stage(df, path, by, counters, fmt, together)
    if refusals is not None and (reasons := refusals(staged.counts)):
        raise Refused(reasons, staged.batch, staged.counts)
    return publish(df.sparkSession, path, staged, sources, replaces)


def read_batches(spark: SparkSession, path: str, batch: str | None = None, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """The published rows, or those of one published batch, with the batch they came in.

    Folders of other batches are not even listed.
    """
    ids = [r["batch"] for r in _published(spark, path) if r["rows"] and batch in (None, r["batch"])]
    if not ids:
        raise ValueError(f"no rows are published in {path}")
    folders = [f"{_data(path)}/batch={i}" for i in ids]
    return spark.read.format(fmt).option("basePath", _data(path)).load(folders)


def new_files(spark: SparkSession, source: str, path: str) -> list[Row]:
    """(source_file, file_size, modified) of the files at a folder or glob that no published batch has taken.

    A file that was replaced by another of the same name is a new one.
    """
    found = spark.read.format("binaryFile").load(source).select(
        F.col("path").alias("source_file"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified"))
    keys = ["source_file", "file_size", "modified"]
    taken = ledger(spark, path).select(*keys).where("source_file IS NOT NULL")
    return found.join(taken, keys, "left_anti").orderBy("source_file").collect()
