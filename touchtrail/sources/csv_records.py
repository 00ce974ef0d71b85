"""Records of CSV files whose fields may hold line breaks, cut by many tasks from one file.

A line break ends a record unless it lies between quotes, so the parity of the quotes in front decides.
Byte ranges, as Spark cuts them, count their own quotes; a prefix scan over the ranges of a file gives
each the parity it begins with, and every range then cuts its own lines as they are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

_RANGE = ["file", "range"]
# Small ranges share a task, up to so many bytes and if there are several tasks for each core.
TASK_BYTES, TASKS_A_CORE = 16 << 20, 4


def _tasks(spark: SparkSession, path: str) -> int:
    """Tasks that ranges are dealt to at most, by the files' sizes; no file is read for that."""
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return max(TASKS_A_CORE * spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def _lines(spark: SparkSession, path: str, tasks: int) -> DataFrame:
    """Lines with their file, byte range and place in it, and whether their quotes are odd in number."""
    quotes = F.length("line") - F.length(F.translate("line", '"', ""))
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("value").alias("line"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("range"),
            F.monotonically_increasing_id().alias("place"),
        )
        .withColumn("odd", quotes % 2)
        .coalesce(tasks)
    )


def _ranges(lines: DataFrame) -> DataFrame:
    """For each range: does it begin and end between quotes, and in which range a record open at its begin started.

    One row per range is sorted by file, whatever the ranges hold.
    """
    counted = lines.groupBy(*_RANGE).agg(
        F.sum("odd").alias("odds"),
        F.min(F.when(F.col("odd") == 1, F.col("place"))).alias("first_odd"),
        F.max("place").alias("last"),
        F.min_by(F.col("line").endswith("\r"), "place").alias("ends_crlf"),
    )
    in_file = Window.partitionBy("file").orderBy("range")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odds").over(before), F.lit(0)) % 2
    # Between quotes, the next record starts behind the first line with an odd number of them.
    starts = (F.col("inside") == 0) | F.coalesce(F.col("first_odd") < F.col("last"), F.lit(False))
    return (
        counted.withColumn("inside", inside)
        .withColumn("open_end", (F.col("inside") + F.col("odds")) % 2 == 1)
        .withColumn("opened_in", F.max(F.when(starts, F.col("range"))).over(before))
        .withColumn("crlf", F.first("ends_crlf").over(in_file))
        .select(F.col("file").alias("_file"), F.col("range").alias("_range"), "inside", "open_end", "opened_in", "crlf")
    )


def _cutter(fragments: bool) -> Callable:
    """Cut the lines of ranges as they pass: records that lie in one range, or the parts of those that leave it.

    A task holds one batch of lines and the record that is open.  The function stands for itself: workers
    need not import this package.
    """

    def cut(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def joined(lines, offsets):
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lines)
            return pc.binary_join(lists, pa.scalar("\n", lines.type))

        def told(records, at, first, home):
            n = len(records)
            columns = {
                "record": records,
                "file": pa.repeat(at["file"], n),
                "first": pa.array([first, *[False] * (n - 1)], pa.bool_()),
                "crlf": pa.repeat(at["crlf"], n),
                "home": pa.array([home] * n, pa.int64()),
                "range": pa.repeat(at["range"], n),
            }
            return pa.RecordBatch.from_pydict(columns)

        def closed(at, end):
            """The open record, at the next one's start or at the end of its range."""
            leaves = not at["started"] or (end and at["open_end"].as_py())
            if at["open"] and leaves == fragments:
                lines = pa.concat_arrays(at["open"])
                home = at["range"].as_py() if at["started"] else at["opened_in"].as_py()
                yield told(joined(lines, [0, len(lines)]), at, at["first"], home if leaves else None)
            at["open"] = []

        at = None
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns))
            files = pc.dictionary_encode(column["file"]).indices.to_numpy()
            ranges = column["range"].to_numpy()
            turns = np.flatnonzero((np.diff(files) != 0) | (np.diff(ranges) != 0)) + 1
            for a, b in zip([0, *turns.tolist()], [*turns.tolist(), len(ranges)]):
                if a == b:
                    continue
                if at is None or (column["file"][a], column["range"][a]) != (at["file"], at["range"]):
                    if at:
                        yield from closed(at, True)
                    at = {k: column[k][a] for k in ("file", "range", "open_end", "opened_in", "crlf")}
                    at |= {"parity": column["inside"][a].as_py(), "started": False, "first": False, "open": []}
                lines = column["line"].slice(a, b - a)
                odd = pc.count_substring(lines, '"').to_numpy() % 2
                parity = at["parity"] + np.cumsum(odd)
                starts = np.flatnonzero((parity - odd) % 2 == 0)
                at["parity"] = int(parity[-1]) % 2
                if not len(starts):
                    at["open"].append(lines)
                    continue
                if starts[0]:
                    at["open"].append(lines.slice(0, int(starts[0])))
                yield from closed(at, False)
                first = not at["started"] and at["range"].as_py() == 0
                if len(starts) > 1 and not fragments:
                    yield told(joined(lines, starts), at, first, None)
                at |= {"started": True, "first": first and len(starts) == 1, "open": [lines.slice(int(starts[-1]))]}
        if at:
            yield from closed(at, True)

    return cut


_CUT = "record string, file string, first boolean, crlf boolean, home bigint, range bigint"


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """``(record, file, first)``: the text of every record, and whether it is the first of its file.

    In files whose lines end in two characters, those in fields become line feeds, as in Spark's reader.
    Quotes must be balanced, as RFC 4180 has it: one inside a field that is not quoted would shift what
    follows.  Files are read three times; each range is worked on by one task, which holds a batch of its
    lines, and only records that leave their range are gathered.  One row per range is sent to all tasks.
    """
    lines = _lines(spark, path, _tasks(spark, path))
    ranges = F.broadcast(_ranges(lines))
    same = (F.col("file") == F.col("_file")) & (F.col("range") == F.col("_range"))
    placed = lines.select("line", "file", "range").join(ranges, same).drop("_file", "_range")
    alone = placed.mapInArrow(_cutter(False), _CUT)
    parts = F.array_sort(F.collect_list(F.struct("range", "record")))
    leaving = placed.mapInArrow(_cutter(True), _CUT).groupBy("file", "home").agg(
        F.array_join(F.transform(parts, lambda x: x["record"]), "\n").alias("record"),
        F.bool_or("first").alias("first"),
        F.bool_or("crlf").alias("crlf"),
    )
    columns = ["record", "file", "first", "crlf"]
    records = alone.select(*columns).unionByName(leaving.select(*columns))
    text = F.regexp_replace("record", "\r$", "")
    text = F.when(F.col("crlf"), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text)
    return records.select(text.alias("record"), "file", "first").where(F.col("record") != "")
