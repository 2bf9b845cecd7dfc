"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.session import ensure_checkpoint_dir

#: The six ASCII white-space characters: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage, and a lost executor re-reads files instead of
    recomputing (or changing) what came before."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows and bytes of one Arrow batch within ``small_batches``.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2048", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


@contextmanager
def small_batches(spark: SparkSession):
    """Jobs run inside hand texts to Python in batches that stay small whatever
    the texts' lengths; the session's own settings come back afterwards."""
    before = {name: spark.conf.get(name) for name in BATCH}
    try:
        for name, value in BATCH.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class Lent:
    """Broadcasts for jobs that end inside a ``with`` block: they are destroyed
    on leaving it, so what is derived from them has to be stored before."""

    def __init__(self, spark: SparkSession):
        self.sc, self.out = spark.sparkContext, []

    def __call__(self, value) -> Broadcast:
        self.out.append(self.sc.broadcast(value))
        return self.out[-1]

    def __enter__(self) -> Lent:
        return self

    def __exit__(self, *_) -> None:
        for sent in self.out:
            sent.destroy()


def on_executors(spark: SparkSession) -> None:
    """Send this package's source and text files to the executors, once per context:
    their Python workers import it by name."""
    sc = spark.sparkContext
    if getattr(sc, "_kpiloom_sent", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="kpiloom-"), "kpiloom_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith((".py", ".txt")):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("kpiloom", os.path.relpath(full, package)))
    sc.addPyFile(path)
    sc._kpiloom_sent = True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    on_executors(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of ``text``; null: none.

    White space is turned into spaces first: splitting by one plain character
    needs no regular expression."""
    plain = F.coalesce(text, F.lit(""))
    for c in WHITE[1:]:
        plain = F.replace(plain, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row (bound as a lambda
    variable, so it is not recomputed inside nested higher-order functions)."""
    return F.element_at(F.transform(F.array(value), body), 1)


class Recent(dict):
    """``compute(key)`` remembered for the keys used of late, in at most twice
    ``limit`` entries: when the newer half is full it becomes the older one."""

    def __init__(self, compute, limit: int, longest: int = 64):
        super().__init__()
        self.compute, self.limit, self.longest, self.older = compute, limit, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value
