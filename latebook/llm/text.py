"""Column expressions on text that several operators share; all of them run in the JVM."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latebook.workspace import shared_root

#: Fixed by the result contracts: what separates words.
WHITE = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: White space that is not already a single space; far rarer than what ``WHITE`` finds.
_UNEVEN = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def plain(text: Column) -> Column:
    """The text; null becomes empty."""
    return F.coalesce(text, F.lit(""))


def spaced(text: Column) -> Column:
    """The words of a text with one space between them.

    Plain searches find the texts that need the pattern, which costs far more than they do.
    """
    uneven = F.contains(text, F.lit("  "))
    for character in "\t\n\x0b\x0c\r":
        uneven = uneven | F.contains(text, F.lit(character))
    return F.trim(F.when(uneven, F.regexp_replace(text, _UNEVEN, " ")).otherwise(text))


def word_count(spaced_text: Column) -> Column:
    """Words of a text that has one space between words and none around them."""
    spaces = F.octet_length(spaced_text) - F.octet_length(F.replace(spaced_text, F.lit(" ")))
    return F.when(spaced_text == "", F.lit(0)).otherwise(spaces + 1)


def words_of(text: Column, separators: str = WHITE) -> Column:
    """The array of words between separators."""
    return F.array_remove(F.split(text, separators), "")


def count_of(text: Column, characters: str) -> Column:
    """How often the given ASCII characters occur; plain replacing is faster than a pattern."""
    left = sum((F.octet_length(F.replace(text, F.lit(c))) for c in characters), F.lit(0))
    return F.octet_length(text) * len(characters) - left


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder, without their lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    with shuffles_released(df.sparkSession):
        written = df.select("*").checkpoint()  # a query follows the settings of when it was made
    relieve(df.sparkSession)
    return written


def relieve(spark: SparkSession) -> bool:
    """Have the driver collect its garbage once a quarter of its heap is in use, and say so.

    Plans and results of finished queries would make the heap grow to its limit before the JVM
    collects them all, and only then does Spark drop what no table refers to any more: broadcasts,
    shuffles and, if it is set to, checkpoints.
    """
    jvm = spark.sparkContext._jvm
    runtime = jvm.java.lang.Runtime.getRuntime()
    full = 4 * (runtime.totalMemory() - runtime.freeMemory()) > runtime.maxMemory()
    if full:
        gc.collect()  # what Python has dropped holds objects of the JVM
        jvm.System.gc()
    return full


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Let Spark delete the shuffle files of a query when it ends; what is read afterwards must be
    written by then."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
