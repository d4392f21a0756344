"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of words, as a Java and RE2 character class.
SPACE = r"[\x20\x09-\x0D]+"

#: A side that is joined as a broadcast holds at most so many bytes; beyond it the join shuffles.
BROADCAST_BYTES = 48 << 20
#: Rows of an Arrow batch that holds texts.
BATCH_ROWS = 4000
#: Bytes of an Arrow batch of lists or texts.
BATCH_BYTES = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset and all runs in one process, as in tests, a
    temporary folder of this machine is set once for the session; executors elsewhere would not see it.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="clinicweave-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: it cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    at = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def sized_batches(df: DataFrame, most: int = BATCH_BYTES) -> DataFrame:
    """``df``, after the session's Arrow batches are limited to ``most`` bytes besides their rows. A smaller limit stays."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(re.sub(r"[bB]$", "", conf.get(name)) or 0) <= most:
        conf.set(name, str(most))
    return df


def bounded_batches(docs: DataFrame) -> DataFrame:
    """``docs``, after the session's Arrow batches are limited to ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes: a worker
    holds a batch of texts at once, however long they are. Smaller limits that the session has stay."""
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return sized_batches(docs)


def join_bounded(big: DataFrame, small: DataFrame, on, how: str, row_bytes: int) -> DataFrame:
    """Join, with ``small`` (a materialized table) as a broadcast only if its counted rows fit ``BROADCAST_BYTES``.

    Beyond that bound both sides are shuffled by the key. ``row_bytes`` bounds a row's size from above.
    """
    fits = small.count() * row_bytes <= BROADCAST_BYTES
    return big.join(F.broadcast(small) if fits else small.hint("merge"), on, how)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def n_words_of(text: Column) -> Column:
    """Number of words, without keeping them."""
    return F.size(words_of(text)).cast("long")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
