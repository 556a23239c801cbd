"""Shared helpers: reading tables, shared scratch tables, row locators, column names."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The ASCII white space of the corpus contracts: space, tab, LF, VT, FF, CR.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


#: Rows of an Arrow batch for functions over whole texts or sets: some MB with usual texts.
BATCH_ROWS = 1_000


def bounded_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for the session: a default batch of long texts is hundreds of MB on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    Only where the session names none and runs in one process (tests) a local one is set; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-tidemark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


def staged(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (Spark resolves names without case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def squeezed(text: Column) -> Column:
    """Each run of ASCII white space becomes one space."""
    return F.regexp_replace(text, ASCII_SPACE, " ")


def crc_fold(id_column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id folds like empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % modulus


#: Bytes of a join's small side up to which it may be broadcast; they are measured first.
BROADCAST_BYTES = 8 << 20


def _bytes(column: Column, kind: T.DataType) -> Column:
    """About how much memory a value of the column takes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = 24 + F.octet_length(column)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)):
        size = F.aggregate(column, F.lit(24).cast("long"), lambda total, x: total + _bytes(x, kind.elementType))
    elif isinstance(kind, T.ArrayType):
        size = 24 + 8 * F.size(column)
    elif isinstance(kind, T.StructType):
        size = sum((_bytes(column[f.name], f.dataType) for f in kind.fields), F.lit(16).cast("long"))
    else:
        size = F.lit(8)
    return F.coalesce(size.cast("long"), F.lit(8).cast("long"))


def size_in_bytes(df: DataFrame) -> int:
    """About the memory that all rows take, from every row; best on staged tables."""
    row = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(24).cast("long"))
    return df.agg(F.sum(row)).first()[0] or 0


def maybe_broadcast(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it takes at most ``most`` bytes (measured), else as it is: a shuffled join."""
    return F.broadcast(df) if size_in_bytes(df) <= most else df
