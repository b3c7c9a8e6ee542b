"""Shared helpers: column picking by exact name, Arrow passes over whole texts, shared tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Rows of one Arrow batch. Texts are of any length, so few rows keep a batch small.
BATCH_ROWS = 1000

# Words by white space: space and 0x09-0x0D, as bytes.split() does.
SPACES = b" \t\n\r\x0b\x0c"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Columns by exact name as ``out_name=type``, whatever else the table holds.

    Extra columns, also ones that differ in case only or stand twice, are left out
    by position, so they can't clash; a wanted column that is absent is an error.
    """
    names = list(df.columns)
    missing = [n for n in wanted if n not in names]
    if missing:
        raise ValueError(f"MISSING_COLUMNS: {missing}")
    plain = df.toDF(*[f"_{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"_{names.index(n)}").cast(t).alias(n) for n, t in wanted.items()])


def packed(df: DataFrame, **wanted: str) -> DataFrame:
    """As ``pick``, with the whole input row beside it as struct ``_row`` (fields by position)."""
    names = list(df.columns)
    plain = df.toDF(*[f"_{i}" for i in range(len(names))])
    return plain.select(F.struct(*plain.columns).alias("_row"),
                        *[F.col(f"_{names.index(n)}").cast(t).alias(n) for n, t in wanted.items()])


def unpacked(df: DataFrame, like: DataFrame, **changed: Column) -> DataFrame:
    """The rows of ``packed`` with the columns of ``like`` again; ``changed`` replaces some."""
    fresh = df.select(*[changed.get(n, F.col("_row")[f"_{i}"]).alias(f"_{i}") for i, n in enumerate(like.columns)])
    return fresh.toDF(*like.columns)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows from here on in this session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(BATCH_ROWS))


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """One Arrow batch in, one out; a partition is never held whole."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := function(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def raw(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as bytes; null is empty."""
    return [b"" if x is None else x for x in batch.column(name).cast(pa.binary()).to_pylist()]


# Where an open ``recorded`` scope notes the folders made in it.
_RECORDS: list[list[str]] = []


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Notes the shared folders made inside, for ``removed`` once what reads them is written."""
    _RECORDS.append(paths)
    try:
        yield
    finally:
        _RECORDS.pop()


def removed(spark: SparkSession, paths: list[str]) -> None:
    while paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder that ``spark.checkpoint.dir`` names."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("CHECKPOINT_DIR_UNSET: set spark.checkpoint.dir to a shared folder")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _RECORDS:
        _RECORDS[-1].append(path)
    return path


def written(df: DataFrame, name: str = "llm") -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and outlives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- words of a text as numpy offsets, and hashes of any run of bytes -------------------------------

_ALNUM = bytes(c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 0x20
               for c in range(256))
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {"p": np.ones(1, np.uint64), "q": np.ones(1, np.uint64)}


def alnum(text: bytes) -> bytes:
    """Lower-case words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` joined by one space."""
    return b" ".join(text.translate(_ALNUM).split())


def powers(which: str, n: int) -> np.ndarray:
    """p**i (or its inverse) modulo 2**64, for i < n; kept and doubled as needed."""
    have = _POWERS[which]
    while len(have) < n:
        step = np.uint64(pow(_P if which == "p" else _P_INV, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    _POWERS[which] = have if len(have) <= 1 << 20 else _POWERS[which]
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads a 64-bit value over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(joined: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every run of ``size`` words of a space-joined text.

    Equal runs have equal hashes wherever they stand: a prefix sum of byte * p**i gives
    any run's polynomial, which is moved back to exponent 0 and mixed. A text of fewer
    words (but one at least) is one run. Unequal runs may collide: verify hits.
    """
    b = np.frombuffer(joined, np.uint8)
    if not len(b):
        e = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), e, e
    gaps = np.flatnonzero(b == 0x20)
    starts = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [len(b)]])
    if len(starts) >= size:
        starts, ends = starts[:len(starts) - size + 1], ends[size - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers("p", len(b)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers("q", len(b))[starts]), starts, ends
