"""Evaluate a costly expression, or a whole stage, once.

The optimizer copies the expression of a computed column into every filter above
it. Handing the values through a one-element ``inline`` keeps the column as it is:
filters on it run after it, and it is computed once per row in the same stage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with added or replaced columns, each evaluated exactly once."""
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    # The projection shares common parts of the expressions, the generator does not.
    return df.select(*kept, row.alias("_row")).select(*kept, F.inline(F.array("_row")))


def spread(df: DataFrame, per_core: int = 4) -> DataFrame:
    """``df`` dealt evenly over all cores, ``per_core`` tasks each.

    A file is split by its bytes and row groups: few wide tasks read a table of many short rows,
    and costly expressions on them would run in these tasks alone. The count is fixed, so the
    small pieces are not put together again."""
    return df.repartition(per_core * df.sparkSession.sparkContext.defaultParallelism)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shared_folder(spark: SparkSession) -> str:
    """Folder for stage tables: the cluster's ``spark.checkpoint.dir``. Only a local
    session without that setting gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="callsheet-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a stage to the shared folder and go on from the written table.

    The lineage ends there, lost executors cost nothing, later stages read only the
    columns they need, and the optimizer knows the table's size."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
