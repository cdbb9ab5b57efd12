"""Helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.sources.tables import cut, forget, table

__all__ = ["KEYS", "busy", "cut", "forget", "fresh", "in_small_batches", "joined_apart", "keyed", "mod20", "pick", "table"]

#: Rows of one key beyond this part of all rows are spread over so many tasks.
PART, PIECES = 1000, 32

#: Bytes of a batch that goes to a Python worker, and rows of one that the Parquet reader makes. Long texts fill Spark's own 64 MB, or 4,096 rows,
#: with tens of MB, which an executor holds several times over, outside its heap too.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4194304", "spark.sql.parquet.columnarReaderBatchSize": "512"}


#: Names of the two halves of a row's key.
KEYS = ("row_k1", "row_k2")


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a 128-bit hash of doc_id and text, never null: rows of equal ids (or none) and other texts have other keys."""
    row = F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit(""))
    return docs.withColumns({name: F.xxhash64(F.lit(i), row[0].isNull(), *row) for i, name in enumerate(KEYS)})


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns of the input never clash with those an operator adds."""
    return df.select(*names)


def in_small_batches(spark: SparkSession) -> SparkSession:
    """The session with ``SMALL_BATCHES`` where it has no settings of its own; results don't depend on them."""
    for name, most in SMALL_BATCHES.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, most)
    return spark


def mod20(name: str):
    """The rows that serve as queries of a search: ids divisible by 20."""
    return F.col(name) % 20 == 0


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front where ``df`` has such a column already."""
    while name in df.columns:
        name = f"_{name}"
    return name


def busy(rows: DataFrame, key: Column | str, n: int) -> DataFrame:
    """(busy_key) whose rows are more than 1 / ``PART`` of all ``n``: fewer than ``PART`` keys, however many rows there are."""
    found = rows.groupBy((F.col(key) if isinstance(key, str) else key).alias("busy_key")).agg(F.count("*").alias("rows"))
    return found.where(F.col("rows") * PART > n).select("busy_key")


def joined_apart(left: DataFrame, right: DataFrame, on: list[str], hot: DataFrame, by: Column, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on ``on``; rows of ``hot`` keys (of the first column of ``on``) are spread.

    ``hot`` is a result of ``busy``, so it may be broadcast. On the left, rows of a hot key take one of ``PIECES`` salts by ``by``; on the
    right each of them is repeated for every salt, which is few rows where ``right`` has one row a key.
    """
    salt, key = F.pmod(F.xxhash64(by), F.lit(PIECES)).cast("int"), on[0]
    mark = lambda df: df.join(F.broadcast(hot), F.col(key) == F.col("busy_key"), "left")
    a = mark(left).withColumn("busy_salt", F.when(F.col("busy_key").isNotNull(), salt).otherwise(0)).drop("busy_key")
    every = F.when(F.col("busy_key").isNotNull(), F.sequence(F.lit(0), F.lit(PIECES - 1))).otherwise(F.array(F.lit(0)))
    b = mark(right).withColumn("busy_salt", F.explode(every)).drop("busy_key")
    return a.join(b, [*on, "busy_salt"], how).drop("busy_salt")
