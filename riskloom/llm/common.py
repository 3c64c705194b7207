"""Helpers the corpus operators share: written hand-over tables, text columns, bounded samples."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import shared_dir

#: ASCII white space as the contracts count it.
SPACE = r"[\x20\x09-\x0D]"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_STORED: list[str] = []


#: Bytes of text a Python worker gets at once: rows are long, so their count says little.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the corpus, in a session that hands texts to Python in small batches."""
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key).rstrip("b")
    if not held.isdigit() or int(held) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def give_back_memory() -> None:
    """Return freed memory of a Python worker to the system; workers live on between tasks.

    Called at the end of a task: first Arrow's own pool, which keeps its largest batches, then the C
    library's. Where the C library has no ``malloc_trim`` only the pool gives back.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` into the shared folder and go on from the written copy.

    The copy cuts lineage and outlives executors. ``drop_stored`` removes what a session wrote.
    """
    path = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STORED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession) -> None:
    """Remove the hand-over tables of this session; call it once results are written."""
    jvm = spark.sparkContext._jvm
    while _STORED:
        path = jvm.org.apache.hadoop.fs.Path(_STORED.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names close to ``names`` that ``df`` does not have, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; null becomes empty."""
    return F.translate(
        F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def encoded(text: str | None) -> bytes:
    """UTF-8 with A-Z lowered; empty for null."""
    if not isinstance(text, str):
        return b""
    return text.encode("utf-8", "replace").translate(_LOWER)


def bounded_sample(
    rows: DataFrame, stratum: str, key: list[Column], per_stratum: int, *columns: str
) -> DataFrame:
    """At most about ``per_stratum`` rows of each stratum, chosen by a hash of ``key``.

    The share kept follows from the stratum's count, so every row had the same chance and the
    sample's size does not depend on the table's. Strata must be few.
    """
    counts = rows.groupBy(stratum).count().collect()
    share = F.lit(0.0)
    for value, n in counts:
        if value is not None:
            share = F.when(F.col(stratum) == F.lit(value), F.lit(min(1.0, per_stratum / n))).otherwise(share)
    draw = F.pmod(F.xxhash64(*key), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(draw < share).select(*columns)


def squared_hinge(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4, steps: int = 200
) -> np.ndarray:
    """Linear SVMs with squared hinge loss, one per column of ``y`` (+1, -1, or 0 for left out).

    Accelerated gradient descent over the whole sample; the last row of ``x``'s weights is the bias
    if ``x`` carries a constant column.
    """
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    ahead, t = w.copy(), 1.0
    used = np.abs(y) * weight
    total = np.maximum(used.sum(0), 1e-9)
    # rows are near unit length, with the constant column at most two; the loss is then 4-smooth
    rate = 1.0 / (2.0 * float((x * x).sum(1).max()) + penalty) if len(x) else 1.0
    for _ in range(steps):
        slack = np.maximum(0.0, 1.0 - y * (x @ ahead)) * used / total
        grad = -2.0 * (x.T @ (slack * y)) + penalty * ahead
        new = ahead - rate * grad
        t_next = (1.0 + np.sqrt(1.0 + 4.0 * t * t)) / 2.0
        ahead = new + ((t - 1.0) / t_next) * (new - w)
        w, t = new, t_next
    return w.astype(np.float32)
