"""Reading tables and small helpers shared by the operators."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callsheet.functions.stages import stored

#: Bytes that separate words.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids have no fold."""
    return F.crc32(doc_id.cast("string")) % parts


def labelled(docs: DataFrame, labels: DataFrame, label: str, learned: Column, few: bool = False) -> DataFrame:
    """``doc_id, text, label`` of the rows to learn from, one per document row.

    ``learned`` is a condition on ``doc_id``, tested on both sides. Rows without label are
    left out; of several labels of one document the larger counts. Unless the labels are
    known to be ``few`` both sides are shuffled, at any size."""
    marks = (labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(learned)
             .filter("label is not null").groupBy("doc_id").agg(F.max("label").alias("label")))
    return docs.select("doc_id", "text").filter(learned).join(marks if few else marks.hint("merge"), "doc_id")


def by_place(docs: DataFrame, nulls: int) -> DataFrame:
    """``doc_id, text, row``: each row's own columns as ``row``, and as ``doc_id`` a number that
    orders rows by their integer id (null ids: first if ``nulls`` is -1, last if 1) and tells
    rows of one id apart by their place in the stored table. Rows that are no plain scan of
    files are stored first."""
    try:
        docs.select("_metadata.row_index").schema
    except AnalysisException:  # no plain scan of files
        docs = stored(docs, "rows")
    at = F.pmod(F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")), F.lit(10**18)).cast("decimal(38,0)")
    unit = F.lit(Decimal(10**18)).cast("decimal(19,0)")
    number = F.coalesce(F.col("doc_id").cast("decimal(19,0)") * unit, F.lit(Decimal(nulls * 10**37))).cast("decimal(38,0)") + at
    return docs.select(number.cast("decimal(38,0)").alias("doc_id"), "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def blobs(texts) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column, null as empty."""
    return [b if b is not None else b"" for b in texts.cast("binary").to_pylist()]


def joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One byte array of all parts, with the start and end of each."""
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
    starts = ends - np.array([len(p) for p in parts], dtype=np.int64)
    return np.frombuffer(b"".join(parts), dtype=np.uint8), starts, ends


def slabs(parts: list[bytes], limit: int = 4 << 20):
    """Index ranges of consecutive parts of about ``limit`` bytes each."""
    first, size = 0, 0
    for i, p in enumerate(parts):
        if size and size + len(p) > limit:
            yield first, i
            first, size = i, 0
        size += len(p)
    if first < len(parts):
        yield first, len(parts)


def spaced(parts: list[bytes], gap: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``joined`` with ``gap`` blanks before each part and after the last."""
    n = np.array([len(p) for p in parts], dtype=np.int64)
    ends = np.cumsum(n + gap)
    filler = b" " * gap
    return np.frombuffer(filler + filler.join(parts) + filler, dtype=np.uint8), ends - n, ends


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, weight: np.ndarray | None = None, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic loss on ``x`` by Newton steps; all columns but none are equal in kind."""
    w = np.zeros(x.shape[1])
    weight = np.ones(len(y)) if weight is None else weight
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w
