"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Multiplier of the multiply-xorshift mixers below (odd, so multiplication is a bijection on 64 bits).
MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only on a single machine (tests) may it be unset: a temporary folder is used then. On a cluster other machines would
    not see that, so it is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        named = tempfile.mkdtemp(prefix="revlens-checkpoint-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint in the shared folder, so that lost executors cannot lose it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def tasks_for(rows: int, each: int = 100_000) -> int:
    """Tasks for so many narrow rows."""
    return 1 + rows // each


def cut_small(df: DataFrame) -> DataFrame:
    """Like ``cut`` for narrow rows, which few tasks go on with if there are few of them: a task leaves files in every shuffle."""
    out = cut(df)
    return out.coalesce(tasks_for(out.count()))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def units_for(df: DataFrame) -> int:
    """Number of work units for a corpus: a few per input split, so that a unit's text stays at tens of MB at any size."""
    return max(shuffle_partitions(df.sparkSession), 2 * df.rdd.getNumPartitions())


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A stable 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes (empty if there are fewer words)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(size), np.uint64)
    for k in range(size):
        out = (out ^ hashes[k : k + n]) * MIX
        out ^= out >> np.uint64(31)
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values, by doubling."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def sorted_member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Mask of ``values`` that occur in the sorted array ``among``."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


def record_batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def blank(column: str) -> F.Column:
    """The text column with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))
