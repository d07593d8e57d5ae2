"""Small helpers of the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gotera.operators.durable import checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4_000_000
KELVIN = "K"  # the only other character that lower() turns into an ASCII letter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_folder(spark: SparkSession, what: str) -> str:
    """A new folder that driver and executors share."""
    return f"{checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """Written once to the shared folder and read again: lineage ends here and survives lost executors."""
    path = run_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class Scratch:
    """Tables that an operator writes on its way, in one shared folder; they go when what is made of them stands."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, run_folder(spark, "scratch")

    def stored(self, df: DataFrame, what: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{what}")
        return self.spark.read.parquet(f"{self.root}/{what}")

    def remove(self, what: str = "") -> None:
        """One table, or the whole folder."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{what}" if what else self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def mapped(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with batches of a few megabytes: rows are texts and sets of any length, and a task holds a batch
    several times (in the executor, on its way, and in Python). A batch size that the session sets is left as it is.

    Python workers serve many tasks; what a task has used is given back to the system at its end.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))

    def run(batches):
        try:
            yield from function(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def beside_text(df: DataFrame, kept: list[str], text: str) -> tuple[DataFrame, int]:
    """The ``kept`` columns and, unless it is one of them, the text as a last column; and the place of the text."""
    for place, name in enumerate(kept):
        if name.lower() == text.lower() and df.select(quoted(name)).schema[0].dataType.simpleString() == "string":
            return df.select(*[quoted(c) for c in kept]), place
    return df.select(*[quoted(c) for c in kept], quoted(text).cast("string").alias("_text")), len(kept)


def give_back() -> None:
    """Free what is no longer used, down to the C library's heap where it can be told to."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Working column names that clash with none of ``taken`` (Spark compares names without case)."""
    used = {t.lower() for t in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """A top-level column whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased; letters outside ASCII may change case too, but never into or out of ASCII."""
    return F.when(F.instr(text, KELVIN) > 0, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
