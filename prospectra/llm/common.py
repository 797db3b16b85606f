"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from prospectra.session import new_path

WORD_SPACE = " \t\n\x0b\x0c\r"
#: Text held at once by a Python worker, in bytes; a longer single text is its own slice.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that lost executors cost no recomputation."""
    path = new_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranged(df: DataFrame, order: list, label: str) -> DataFrame:
    """The rows written in ranges of ``order`` and read back, with the number of their range as ``_part``.

    Ranges may divide the rows of one key, so that a hot key is spread; ``order`` should tell rows apart.
    """
    return cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), label)


def in_ranges(df: DataFrame, order: list) -> DataFrame:
    """The rows of ``ranged`` with whole ranges in tasks, sorted by range and ``order``."""
    return df.repartition("_part").sortWithinPartitions("_part", *order)


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[list[str | None]]:
    """The texts of an Arrow batch in runs of about ``limit`` bytes."""
    first, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if held and held + n > limit:
            yield texts.slice(first, i - first).to_pylist()
            first, held = i, 0
        held += n
    if first < len(texts):
        yield texts.slice(first).to_pylist()


def digest(parts: list[str]) -> str:
    """Lower-case hex SHA-256 of comma-joined parts."""
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    out = values.astype(np.uint64)
    out ^= out >> np.uint64(30)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


def fields(df: DataFrame, keep: list[str], made: str) -> DataFrame:
    """``keep`` and the members of one computed struct column."""
    return df.select(*keep, F.col(f"{made}.*"))
