"""Grouping writes of a partition into batches of bounded rows or bytes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def by_rows(df: DataFrame, key: Sequence[str], order: Sequence[str], most: int = 32) -> DataFrame:
    """df plus batch: consecutive rows of a partition, `most` at a time, from 0."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1
    return df.withColumn("batch", F.floor(place / most).cast("long"))


def batch_sizes(df: DataFrame, key: Sequence[str], order: Sequence[str], most: int = 32) -> DataFrame:
    """size, n: how many batches have how many rows.

    From the partitions' row counts alone: no rows are sorted, only partial counts are shuffled.
    """
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("c"))
    full = counts.select(F.floor(F.col("c") / most).alias("k")).agg(F.sum("k").alias("n")).select(F.lit(most).cast("long").alias("size"), "n").where("n > 0")
    rest = counts.select((F.col("c") % most).alias("size")).where("size > 0").groupBy("size").agg(F.count(F.lit(1)).alias("n"))
    return full.unionByName(rest).groupBy("size").agg(F.sum("n").cast("long").alias("n"))


def by_bytes(df: DataFrame, key: Sequence[str], order: Sequence[str], size: str, most: int) -> DataFrame:
    """df plus batch: a batch closes with the row that brings it to `most` bytes.

    A running sum that begins anew isn't a window function. The rows of a key are sorted within one
    Spark partition and summed as they stream by, so no group is held in memory.
    """
    keys, schema = list(key), StructType([*df.schema, StructField("batch", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total, no = None, 0, 0
        for b in batches:
            out = []
            for k, s in zip(zip(*(b.column(c).to_pylist() for c in keys)), b.column(size).to_pylist()):
                if k != last:
                    last, total, no = k, 0, 0
                out.append(no)
                total += s or 0
                if total >= most:
                    total, no = 0, no + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], [*b.schema.names, "batch"])

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
