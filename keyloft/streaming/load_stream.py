"""Loading files as they arrive in a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from ..plans.load import LoadSettings, load
from ..schema import TableSpec
from ..sources.csv import Csv
from ..table import KeyedTable


def read_folder(spark: SparkSession, path: str, schema: StructType, form: Csv = Csv(), files_per_batch: int | None = None) -> DataFrame:
    """New delimited files of a folder as a stream; files_per_batch limits the rate."""
    reader = spark.readStream.schema(schema).options(**form.options())
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader
    return reader.csv(path)


def load_stream(
    records: DataFrame, spec: TableSpec, table: Callable[[], DataFrame], save: Callable[[DataFrame, int], None],
    checkpoint: str, settings: LoadSettings = LoadSettings(), bad: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Merge each batch into the table: `table` reads its present state, `save` stores the next.

    Spark's checkpoint says which files are done, so a rerun takes up where it ended. `save` gets
    the batch's number and must make a repeated one harmless, as by writing to a folder of that name.
    """

    def step(batch: DataFrame, number: int) -> None:
        state, rejected = load(batch, table(), spec, settings)
        save(state, number)
        if bad is not None:
            bad(rejected, number)

    return records.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def load_into(records: DataFrame, table: KeyedTable, name: str, checkpoint: str, settings: LoadSettings = LoadSettings(), bad: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Merge each batch into a keyed table: only the buckets that it touches are read and written.

    The table's manifest holds the last batch of each stream by name, so a batch that Spark repeats
    after a failure is merged once.
    """

    def step(batch: DataFrame, number: int) -> None:
        rejected = table.load(batch, settings, batch=(name, number))
        if bad is not None:
            bad(rejected, number)

    return records.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counted(records: DataFrame, column: str, window: str, by: str, late: str = "1 hour") -> DataFrame:
    """Rows per time window and key, closed once later times pass by `late`."""
    return records.withWatermark(column, late).groupBy(F.window(column, window), by).agg(F.count(F.lit(1)).alias("n"))
