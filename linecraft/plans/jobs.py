"""Whole jobs: source → operators → sink, one function per original program.

Each job returns what it learned (counts) and writes through Spark's commit
protocol, so a lost executor only re-runs its tasks and a failed job leaves
no half-written output. Every output path is checked before the first write.
``mode`` is the save mode of every output (``errorifexists`` by default, as a
text-file save; ``overwrite`` to re-run a job into the same folder).

``options`` (e.g. object-store keys from
:func:`linecraft.sources.object_store_options`) go to the reads and the writes
of the job, and only to them; ``output_options`` replace them for the writes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import EMPTY_INPUT_MESSAGE
from ..functions.text import pair_text
from ..operators.access_log import RECORD_COLUMNS, tag_access_log
from ..operators.layout import spread
from ..operators.lifecycle import application_events
from ..operators.partition_report import MARK, partition_report, report_json, report_marks, report_of_marks, report_of_unread
from ..operators.words import count_words, count_words_and_marks
from ..sinks.files import (
    EXIST_MODES,
    beside,
    check_targets,
    file_system,
    publish,
    remove_folder,
    write_json_lines,
    write_pairs_text,
    write_records,
    write_text,
)
from ..sources.event_log import read_event_log_lines
from ..sources.text import read_lines

Options = Mapping[str, str] | None


class EmptyInputError(AssertionError):
    """The input has no line at all."""


def _write_options(options: Options, output_options: Options) -> Options:
    return options if output_options is None else output_options


def _with_width(spark: SparkSession, partitions: int | None) -> SparkSession:
    """A session with the settings of ``spark`` and its own number of shuffle
    partitions, so that no other user of ``spark`` sees it."""
    if partitions is None:
        return spark
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return own


def _moved(mode: str) -> bool:
    """Whether outputs of this save mode can be moved into place as whole folders."""
    return mode in (*EXIST_MODES, "overwrite")


def word_count_job(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    options: Options = None,
    shuffle_partitions: int | None = None,
    mode: str = "errorifexists",
    output_options: Options = None,
) -> None:
    """Count the words of text files and save ``(word,count)`` lines.

    One job of two stages: scan → split → partial count, shuffle on the word,
    final count → write. ``shuffle_partitions`` is the width of that shuffle
    (default: the session's setting); adaptive execution may merge small ones.
    """
    to = _write_options(options, output_options)
    check_targets(spark, [output_path], mode, to)
    lines = spread(read_lines(_with_width(spark, shuffle_partitions), input_path, options))
    write_pairs_text(count_words(lines, "value"), output_path, mode=mode, options=to)


def _tagged_input(spark: SparkSession, input_path: str, options: Options, on_error: str) -> tuple[DataFrame, Observation]:
    """Tagged lines whose counts are observed while they are written; raises
    on an empty input, reading no further than the first line."""
    raw = read_lines(spark, input_path, options)
    # On the scan itself: stops at the first line, before any shuffle.
    if raw.isEmpty():
        raise EmptyInputError(EMPTY_INPUT_MESSAGE)
    obs = Observation("access_log_counts")
    tagged = tag_access_log(spread(raw), on_error=on_error).observe(
        obs,
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("parsed") == 0).alias("failed"),
        F.count_if(F.col("parsed") == 1).alias("ok"),
    )
    return tagged, obs


def log_analysis_job(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    fmt: str = "parquet",
    options: Options = None,
    on_error: str = "reject",
    rejects_path: str | None = None,
    mode: str = "errorifexists",
    output_options: Options = None,
) -> dict[str, int]:
    """Parse access logs, save the parsed records, return
    ``{"total", "failed", "ok"}``.

    Raises :class:`EmptyInputError` ("No Data found in RDD") before anything
    is written if the input has no line. The counts are observed while the
    lines are written, so the logs are scanned and parsed once.

    With ``rejects_path`` the rejected lines are saved with their reason. The
    one pass then writes all records, and the raw lines of rejects only, to a
    folder beside the output that is removed in the end; both outputs are copied
    from its two halves, next to their places, and moved there when both are
    whole (under ``errorifexists`` and ``overwrite``; ``append`` writes them in
    turn). So a failure leaves neither of them.
    """
    to = _write_options(options, output_options)
    check_targets(spark, [output_path] + ([rejects_path] if rejects_path else []), mode, to)
    tagged, obs = _tagged_input(spark, input_path, options, on_error)
    if rejects_path is None:
        write_records(tagged.where("parsed = 1").select(*RECORD_COLUMNS), output_path, fmt=fmt, mode=mode, options=to)
        return {k: int(v) for k, v in obs.get.items()}
    write = dict(to or {})
    both = beside(output_path, "tagged")
    # a parsed line's text is in its fields; only rejects need the line itself
    lean = tagged.withColumn("value", F.when(F.col("parsed") == 0, F.col("value")))
    parts = [beside(output_path, "records"), beside(rejects_path, "rejects")] if _moved(mode) else []
    records_to, rejects_to = parts or (output_path, rejects_path)
    try:
        lean.write.options(**write).partitionBy("parsed").parquet(both)
        halves = spark.read.options(**write).schema(lean.schema).parquet(both)
        rejects = halves.where("parsed = 0").select("value", F.col("reject_reason").alias("reason"))
        write_records(halves.where("parsed = 1").select(*RECORD_COLUMNS), records_to, fmt=fmt, mode=mode, options=to)
        write_records(rejects, rejects_to, fmt=fmt, mode=mode, options=to)
        if parts:
            publish(spark, [(records_to, output_path), (rejects_to, rejects_path)], mode, to)
    finally:
        for path in (both, *parts):
            remove_folder(spark, path, to)
    return {k: int(v) for k, v in obs.get.items()}


def log_tagging_job(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    options: Options = None,
    on_error: str = "reject",
    mode: str = "errorifexists",
    output_options: Options = None,
) -> dict[str, int]:
    """Parse access logs once and save every line, tagged, as one parquet
    dataset partitioned by ``parsed``: records under ``parsed=1``, rejected
    lines with their ``reject_reason`` under ``parsed=0``. Returns
    ``{"total", "failed", "ok"}``.

    One scan, one parse, one write; readers of the records filter on
    ``parsed = 1``, which prunes to that folder.
    """
    to = _write_options(options, output_options)
    check_targets(spark, [output_path], mode, to)
    tagged, obs = _tagged_input(spark, input_path, options, on_error)
    tagged.write.mode(mode).options(**dict(to or {})).partitionBy("parsed").parquet(output_path)
    return {k: int(v) for k, v in obs.get.items()}


def word_count_with_report_job(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    report_path: str,
    options: Options = None,
    mode: str = "errorifexists",
    count_rows: bool = True,
    output_options: Options = None,
) -> None:
    """Word count plus one JSON report per input partition (where it ran and,
    with ``count_rows``, how many lines), in one pass over the input.

    The scan's rows carry marks that are counted like words
    (:func:`linecraft.operators.partition_report.report_marks`); the counts leave
    in one write, words and marks in folders of their own, and the words' folder
    is moved to its place. Partitions without any line are run once more for
    their report, which reads nothing. Neither output appears alone.

    An input with oversized unsplittable files, whose lines are dealt to other
    tasks, is scanned twice: the report describes the tasks that read the files.
    So it is under ``append``.
    """
    to = _write_options(options, output_options)
    check_targets(spark, [output_path, report_path], mode, to)
    lines = read_lines(spark, input_path, options)
    dealt = spread(lines)
    if dealt is not lines or not _moved(mode):
        report = report_json(partition_report(lines, count_rows=count_rows))
        write_text(report, report_path, col="json", mode=mode, options=to)
        write_pairs_text(count_words(dealt, "value"), output_path, mode=mode, options=to)
        return
    both, told = beside(output_path, "counted"), beside(report_path, "report")
    write = dict(to or {})
    try:
        counts = count_words_and_marks(lines, "value", report_marks(count_rows))
        is_mark = F.col("word").startswith(MARK)
        rows = counts.select(
            F.when(is_mark, F.concat(F.col("cnt").cast("string"), F.lit(MARK), "word")).otherwise(pair_text("word", "cnt")).alias("value"),
            F.when(is_mark, "marks").otherwise("words").alias("kind"),
        )
        rows.write.options(**write).partitionBy("kind").text(both)
        if not _has(spark, f"{both}/kind=words", to):  # an input without words
            write_text(rows.where("false").select("value"), f"{both}/kind=words", options=to)
        report = _report_of_counted(spark, lines, f"{both}/kind=marks", to, count_rows)
        write_text(report_json(report), told, col="json", options=to)
        publish(spark, [(f"{both}/kind=words", output_path), (told, report_path)], mode, to)
    finally:
        for path in (both, told):
            remove_folder(spark, path, to)


def _has(spark: SparkSession, path: str, options: Options) -> bool:
    p, fs = file_system(spark, path, options)
    return fs.exists(p)


def _report_of_counted(spark: SparkSession, lines: DataFrame, path: str, options: Options, count_rows: bool) -> DataFrame:
    """The report of all partitions of ``lines`` from the marks counted in them
    (lines ``<count> <mark>``), and from a run over those without any row."""
    n = lines._jdf.queryExecution().toRdd().getNumPartitions()
    if not _has(spark, path, options):
        return report_of_unread(lines, list(range(n)), count_rows)
    cut = F.locate(MARK, "value")
    marks = read_lines(spark, path, options).select(
        F.substring("value", F.lit(1), cut - 1).cast("bigint").alias("cnt"), F.expr("substring(value, locate(' ', value) + 1)").alias("word")
    )
    told = report_of_marks(marks, count_rows)
    unread = spark.range(n).join(told, F.col("id") == F.col("partition_id"), "left_anti").collect()
    if not unread:
        return told
    return told.unionByName(report_of_unread(lines, sorted(r["id"] for r in unread), count_rows))


def application_events_job(
    spark: SparkSession,
    log_paths: str | list[str],
    output_path: str,
    mode: str = "errorifexists",
    options: Options = None,
    output_options: Options = None,
) -> None:
    """Start and end messages of every application in event-log folders,
    saved as JSON lines ``app_id, event, time_ms, message``."""
    to = _write_options(options, output_options)
    check_targets(spark, [output_path], mode, to)
    events = application_events(read_event_log_lines(spark, log_paths, options=options))
    write_json_lines(events, output_path, mode=mode, options=to)
