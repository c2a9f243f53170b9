"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rides.session import ensure_checkpoint_dir, shared_dir, ship_package

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
# The characters \x20 and \x09-\x0D, which end a word.
SPACES = " \t\n\x0b\x0c\r"


def prepare(spark: SparkSession) -> None:
    """Settings every operator here relies on: the shared folder and the
    package on the Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables, in the cluster's shared folder."""
    return shared_dir(spark, "llm", name, unique=True)


# Spark removes an execution's shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts
    the lineage with files that outlive any executor, and lets the shuffles
    that made them go."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda variable is
    bound to the value, where a plain reference would be inlined and
    evaluated again for each use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def space_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text (null: none) as an array."""
    blanked = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(blanked, " "), "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and leave every other character."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def release() -> None:
    """Give freed memory back to the system. Spark uses a Python worker for
    other tasks and stages, and the allocators would hold on to the most that
    any of them took."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc alone has it
    if trim:
        trim(0)


def map_arrow(df: DataFrame, fn: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        from rides.llm import tokens

        if tokens.forget(TaskContext.get().stageId()):
            release()
        try:
            yield from fn(batches)
        finally:
            release()

    prepare(df.sparkSession)
    return df.mapInArrow(run, schema)


def slices(texts: list, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of about ``limit`` characters, at least one text each."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)
