"""Raw text files as a stream of keyed messages: new files become messages as they arrive."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txrisk.sources.messages import line_messages
from txrisk.sources.raw import numbered, text_lines
from txrisk.streaming.history import write_batch


def replay_files(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    messages_path: str,
    glob: str = "*.txt",
    files_per_batch: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Send the lines of files under ``path``, each file's once, to a folder of messages (key, value, timestamp).

    A file comes whole in one micro-batch, so that its header and line numbers are those of the batch
    job ``file_messages``; a micro-batch has ``files_per_batch`` files at most. A batch that is repeated replaces
    what it wrote.
    """
    reader = spark.readStream.option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def run(lines: DataFrame, batch_id: int) -> None:
        # Read for the counts per block, the headers and the messages.
        kept = lines.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sent = line_messages(numbered(kept)).withColumn("timestamp", F.current_timestamp())
            write_batch(sent, messages_path, batch_id)
        finally:
            kept.unpersist()

    writer = text_lines(reader.text(path)).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
