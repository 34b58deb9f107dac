"""The same operators over a directory that keeps receiving files.

Structured Streaming runs the access-log parse and the word count
incrementally: each trigger reads only new files, the checkpoint (under the
session's shared checkpoint folder unless given) records progress, and the
file sink commits each micro-batch exactly once, so a restart after a lost
driver or executor neither skips nor repeats input.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.access_log import access_log_counts, tag_access_log
from ..operators.words import count_words
from ..session import checkpoint_root


def stream_lines(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``value string`` lines of the text files that appear in
    ``input_dir``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(input_dir)


def _checkpoint(spark: SparkSession, name: str, given: str | None, *paths: str) -> str:
    # One folder per (job kind, input, output): two streams never share
    # progress or state, and a restarted stream finds its own again.
    if given:
        return given
    key = hashlib.sha1("\n".join(paths).encode()).hexdigest()[:16]
    return f"{checkpoint_root(spark)}/linecraft-stream-{name}-{key}"


def start_parsed_log_stream(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    checkpoint: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Parse new access-log files as they arrive and append every line,
    tagged, to parquet files in ``output_dir``, partitioned by ``parsed``:
    records under ``parsed=1``, rejected lines with their ``reject_reason``
    under ``parsed=0``. Stateless: no state store, each line is handled once."""
    tagged = tag_access_log(stream_lines(spark, input_dir))
    writer = (
        tagged.writeStream.format("parquet")
        .partitionBy("parsed")
        .option("path", output_dir)
        .option("checkpointLocation", _checkpoint(spark, "parsed-logs", checkpoint, input_dir, output_dir))
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_running_counts_stream(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    kind: str = "words",
    checkpoint: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Running totals over all files seen so far: word counts
    (``kind="words"``) or access-log ``total, failed, ok``
    (``kind="log_counts"``).

    The totals live in the state store of the checkpoint (one partial row per
    word per micro-batch is merged into it, never the raw lines). After each
    micro-batch the rows that changed are written to
    ``output_dir/batch_id=<n>``; the highest ``batch_id`` of a key holds its
    current total. A batch that is re-run after a failure overwrites its own
    folder, so no row is written twice.
    """
    lines = stream_lines(spark, input_dir)
    if kind == "words":
        totals = count_words(lines, "value")
    elif kind == "log_counts":
        totals = access_log_counts(tag_access_log(lines), fail_on_empty=False)
    else:
        raise ValueError(f"kind must be 'words' or 'log_counts', not {kind!r}")

    def _write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output_dir.rstrip('/')}/batch_id={batch_id}")

    writer = (
        totals.writeStream.outputMode("update")
        .option("checkpointLocation", _checkpoint(spark, f"counts-{kind}", checkpoint, input_dir, output_dir))
        .foreachBatch(_write_batch)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
