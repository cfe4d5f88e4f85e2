"""From raw documents to packed training windows in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its
result is written as Parquet and read again for the next one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from callsheet.functions.stages import stored
from callsheet.llm import exact_dedup, mixing, packing, quality, simhash
from callsheet.llm.common import by_place, table


def _row(docs: DataFrame):
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking does not reject. Null and empty texts are scored
    like any other; rows repeated whole share their score and stay or go together."""
    scored = quality.score_quality(docs, table(spark, sf_dir, "labels"), row=_row(docs))
    return scored.filter("predicted = 1").select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of equal texts: the one with the largest id (null ids last in choice), of rows
    that share it any one, also of rows repeated whole. A null text equals an empty one."""
    return exact_dedup.exact_dedup(by_place(docs, nulls=-1), row=F.col("row")).filter("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the one with the smallest id, null ids last, of
    rows that share it any one. Blank texts are one group."""
    rows = by_place(docs, nulls=1)
    groups = simhash.near_duplicates(rows.select("doc_id", "text"))
    kept = groups.filter("doc_id = component_id").select("doc_id")
    return rows.join(kept, "doc_id", "left_semi").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; texts without words are not
    taken, a null source is a source of its own."""
    return mixing.mixed_rows(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows; each piece with a checksum of its ids. Rows repeated by the mix are
    packed each."""
    return packing.digests(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality", keep_good), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("mix", mix_sources), ("pack", pack_windows)]

#: Learned scores, fingerprints and token ids are beyond SQL; tests hold it against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left after all stages; an empty table gives none.
    Other columns than ``doc_id``, ``text`` and ``source`` decide nothing and may have any name."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
