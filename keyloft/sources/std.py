"""Standard input and output of the driver, for small data in a shell pipe."""

from __future__ import annotations

import sys
from collections.abc import Iterable
from typing import TextIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, stream: Iterable[str] = sys.stdin, source: str = "std:") -> DataFrame:
    rows = [(line.rstrip("\r\n"), i) for i, line in enumerate(stream, 1)]
    return spark.createDataFrame(rows, "value string, _position long").withColumn("_resource", F.lit(source))


def write_lines(df: DataFrame, stream: TextIO = sys.stdout) -> int:
    """Print the one text column, a partition at a time."""
    n = 0
    for row in df.toLocalIterator(prefetchPartitions=True):
        stream.write(f"{row[0]}\n")
        n += 1
    return n
