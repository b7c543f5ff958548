"""Landing folders and growing tables as streams.

A checkpoint knows which files are done. A micro-batch that is repeated after a failure adds
nothing twice, because keys already in the table are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from litscreen import schemas
from litscreen.operators import extract
from litscreen.sinks.tables import append_unseen
from litscreen.sources import files
from litscreen.sources.tables import create_once, exists, file_system


def article_stream(
    spark: SparkSession,
    root: str,
    files_per_batch: int | None = None,
    glob: str = files.ARTICLES,
    folder: str = files.FOLDER_IN_PATH,
    name: str = files.ID_IN_PATH,
) -> DataFrame:
    """Articles as they land: the same files and columns as the batch reader gives."""
    reader = spark.readStream.format("binaryFile").schema(schemas.BINARY_FILE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return files.as_articles(reader.load(f"{root.rstrip('/')}/{glob}"), folder, name)


def record_stream(
    spark: SparkSession, root: str, files_per_batch: int | None = None, schema: T.StructType = schemas.ARTICLES_RAW
) -> DataFrame:
    """Records as they land, many to a file: the rows that :func:`files.read_records` gives."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(root).select(*schema.names)


def drop_seen(
    stream: DataFrame, key: str, event_time: str | None = None, delay: str | None = None
) -> DataFrame:
    """Let each key through once. With a delay the state of old keys is given up.

    Which row of one micro-batch stays is open; use :func:`append_stream` where it matters.
    """
    if event_time and delay:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def first_seen(stream: DataFrame, key: str, order: str, event_time: str, live: str, delay: str = "0 seconds") -> DataFrame:
    """The first row of each key by ``order``, once for as long as the key is remembered.

    Of the rows of a key in one micro-batch that of the least ``order`` is let through (missing ones come last). The
    state of a key ends ``live`` after the time of that row, and then the key may come again: the state is bounded by
    the keys of that time. Time is that of the rows; rows that come later than ``delay`` are left out.
    """
    length = int(pd.Timedelta(live).total_seconds() * 1000)

    def first(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        until = state.get[0] if state.exists else None
        least = None
        for rows in batches:
            if until is not None:
                rows = rows[rows[event_time].astype("datetime64[ms]").astype("int64") >= until]
            rows = rows if least is None else pd.concat([least, rows])
            least = rows.sort_values(order, kind="stable", na_position="last").head(1)
        if least is not None and len(least):
            until = int(least[event_time].astype("datetime64[ms]").astype("int64").iloc[0]) + length
            yield least
        if until <= state.getCurrentWatermarkMs():
            if state.exists:
                state.remove()
        else:
            state.update((until,))
            state.setTimeoutTimestamp(until)

    timed = stream.withWatermark(event_time, delay).filter(F.col(event_time).isNotNull())
    return timed.groupBy(key).applyInPandasWithState(first, stream.schema, "until long", "append", GroupStateTimeout.EventTimeTimeout)


def append_stream(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    key: str,
    order: list[Column],
) -> StreamingQuery:
    """Process what has arrived, keep the first row of each key and append it to a table.

    The number of the last batch that was appended is noted beside the checkpoint: a batch that Spark repeats, because
    it was lost before it was marked as done, is skipped without looking at its rows.
    """
    done = f"{checkpoint}/appended"

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if exists(spark, f"{done}/{number}"):
            return
        append_unseen(transform(batch), path, key, order)
        create_once(spark, f"{done}/{number}", "")
        files, before = file_system(spark, f"{done}/{number - 1}")
        files.delete(before, False)

    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def abstract_stream(articles: DataFrame, path: str, checkpoint: str, element: str = "abstract") -> StreamingQuery:
    """Keep the abstract data set up to date with a stream of raw articles."""
    def rows(batch: DataFrame) -> DataFrame:
        return extract.dataset_rows(extract.abstracts(files.decode(batch), element))

    return append_stream(articles, rows, path, checkpoint, "ID", [F.col("query_folder"), F.col("fetched_at")])
