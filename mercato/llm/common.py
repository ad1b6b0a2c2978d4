"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import ensure_checkpoint_dir

#: The white space that separates words: space and U+0009 to U+000D.
WORD_GAP = "[\\x20\\x09-\\x0D]+"
GAP_CHARS = " \t\n\u000b\f\r"
#: Spark's setting that removes an execution's shuffle files at its end, not when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders written since ``settled`` began, where it is under way.
_on_the_way: ContextVar[list[str] | None] = ContextVar("_on_the_way", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a fresh folder under the shared checkpoint folder and read it back.

    Cuts the lineage and survives lost executors: later stages read files, not cached blocks.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    if (paths := _on_the_way.get()) is not None:
        paths.append(path)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the frames made and run (or written) inside go as soon as each run ends."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """Write what ``make`` returns; the tables written on the way to it are removed, as nothing reads them again."""
    outer = _on_the_way.get()
    mark = _on_the_way.set([])
    try:
        out = written(make(), name)
        *passed, path = _on_the_way.get()
    finally:
        _on_the_way.reset(mark)
    if outer is not None:
        outer.append(path)
    _remove(out.sparkSession, passed)
    return out


def _remove(spark: SparkSession, paths: list[str]) -> None:
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:  # a remote (Connect) session reaches no file system: the folders stay
        return
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


def words(text: Column) -> Column:
    """The words of a text (null: none), in order. Trimmed first, so that one split leaves no empty strings."""
    solid = F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS))
    return F.when(solid != "", F.split(solid, WORD_GAP)).otherwise(F.array().cast("array<string>"))


def text_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def private(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with those of ``df`` (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_batches(batches: Iterator, column: int, limit: int) -> Iterator:
    """Split Arrow batches so that each holds about ``limit`` bytes of text (at least one row)."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        part = np.cumsum(size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
