"""CSV files whose header is not on line 1, as records.

Each file gives rows ``(path, header, line_no, record, error)``. The header is the first of the leading
``max_rows`` lines with at least two cells and no blank one; lines before it are dropped. A file that
cannot be read gives one row with ``error`` and no record, and stops no other file. One with a header
alone gives one row without error and record. Lines end in a line feed, a carriage return or both.

Small files without line breaks in cells are cut into lines in place: one narrow pass. A file above
``whole_bytes``, or one with line breaks in cells, is read as splittable text, so a huge file is shared
by many tasks. Its lines are numbered within each split and staged, since a later pass may cut splits
elsewhere. Quote state then runs along each split and along the list of splits: no step holds a file
in one task. A file that ends inside quotes is known from its splits and rejected before its lines are
put together. Carriage returns alone do not make a file splittable: up to the next line feed, it is one line to
Spark's reader.

Many files are read by groups, so that the driver never lists them all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dosecast.functions import csv_text
from dosecast.operators.joins import dimension_join
from dosecast.sources import discovery
from dosecast.sources.staging import stage, stage_all

MAX_HEADER_ROWS = 10
WHOLE_BYTES = 16 * 1024 * 1024
FEW_FILES = 1000

NO_HEADER = "no valid header"
LONG_ROW = "row longer than header"
BAD_TEXT = "not UTF-8"
OPEN_QUOTE = "quote never closed"
_OUT = ("path", "header", "line_no", "record", "error")


def _header_cells(line: Column) -> Column:
    return csv_text.cells(F.regexp_replace(line, "^\ufeff", ""))


def _without_end(line: Column) -> Column:
    return F.regexp_replace(line, r"(\r?\n|\r)\z", "")


def _is_blank(record: Column) -> Column:
    return F.btrim(record, F.lit(" \t\r")) == ""


def _few_paths(files: DataFrame) -> list[str] | None:
    """Patterns of the paths, if they are few enough to name to one reader; else None."""
    paths = [r["path"] for r in files.select("path").limit(FEW_FILES + 1).collect()]
    return [discovery.exactly(p) for p in paths] if len(paths) <= FEW_FILES else None


def _staged_reads(
    spark: SparkSession, reader: DataFrameReader, files: DataFrame, read: Callable[[DataFrame, int | None], DataFrame], label: str
) -> DataFrame:
    """What ``read`` makes of the named files, and only of these, staged. It is given a reader's frame and a number of tasks, if any.

    Many files are read by groups, each written before the next is listed: the driver never has all of them.
    """
    few = _few_paths(files)
    if few is not None:
        return stage(read(reader.load(few), None), label)
    groups = discovery.file_groups(files)
    return stage_all((read(discovery.load_group(spark, reader, paths), tasks) for paths, tasks in groups), label)


def _in_tasks(df: DataFrame, tasks: int | None) -> DataFrame:
    return df.coalesce(tasks) if tasks else df


def read_ragged_csv(
    spark: SparkSession,
    paths: list[str],
    chosen: DataFrame | None = None,
    glob: str | None = None,
    max_rows: int = MAX_HEADER_ROWS,
    whole_bytes: int = WHOLE_BYTES,
) -> DataFrame:
    """Records of the files below ``paths``; of those in ``chosen`` (column ``path``, better with ``length``) if given."""
    chosen = discovery.list_files(spark, *paths, glob=glob) if chosen is None else chosen
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")

    # one pass over the files: records, or for a large file or one with breaks in cells a row that only names it
    def cut(found: DataFrame, tasks: int | None) -> DataFrame:
        files = found.select("path", "length", "content", F.col("_metadata.file_path").alias("uri"))
        numbered = F.transform("body", lambda line, at: F.struct(at.alias("at"), line.alias("record")))
        filled = F.filter(numbered, lambda x: ~_is_blank(x["record"]))
        checked = _cut_in_place(files.where(F.col("length") <= whole_bytes), max_rows)
        lines = checked.withColumn("_line", F.explode_outer(filled)).select(
            "path", "uri", "length", "header", "error", "header_at", "multi_line", "_line.*"
        )
        large = files.where(F.col("length") > whole_bytes).select("path", "uri", "length", F.lit(True).alias("multi_line"))
        return _in_tasks(lines.unionByName(large, allowMissingColumns=True), tasks)

    first_pass = _staged_reads(spark, reader, chosen, cut, "csv-first-pass")
    narrow = first_pass.where(~F.col("multi_line")).select(
        "path", "header", (F.col("header_at") + F.col("at")).alias("line_no"), "record", "error"
    )
    split = first_pass.where("multi_line").select("path", "uri", "length")
    if split.isEmpty():
        return narrow
    return narrow.unionByName(_read_splits(spark, stage(split, "split-files"), max_rows))


def _cut_in_place(files: DataFrame, max_rows: int) -> DataFrame:
    """Per small file: header, body lines, error, and whether some cell holds a line break."""
    content = F.col("content").cast("string")
    lines = F.split(content, "\r\n|\n|\r")
    cut = files.select("path", "uri", "length", F.is_valid_utf8(content).alias("_valid"), lines.alias("_lines"))
    head = F.slice("_lines", 1, max_rows)
    # 1-based position, 0 for none
    cut = cut.withColumn("header_at", F.array_position(F.transform(head, csv_text.is_header), F.lit(True)).cast("int"))
    cut = cut.withColumns(
        {
            "header": F.when(F.col("header_at") > 0, _header_cells(F.get("_lines", F.col("header_at") - 1))),
            "_body": F.when(F.col("header_at") > 0, F.slice("_lines", F.col("header_at") + 1, F.size("_lines"))),
        }
    )
    opens = F.exists(F.slice("_lines", F.greatest("header_at", F.lit(1)), F.size("_lines")), csv_text.ends_open)
    width = F.size("header")
    too_long = F.exists("_body", lambda line: csv_text.n_cells(line) > width)
    cut = cut.withColumn("multi_line", F.col("_valid") & (F.col("header_at") > 0) & opens)
    error = (
        F.when(~F.col("_valid"), BAD_TEXT)
        .when(F.col("header_at") == 0, NO_HEADER)
        .when(~F.col("multi_line") & too_long, LONG_ROW)
    )
    cut = cut.withColumn("error", error)
    return cut.select(
        "path", "uri", "length", "header", "header_at", "multi_line", "error",
        F.when(F.col("error").isNull() & ~F.col("multi_line"), F.col("_body")).alias("body"),
    )


# ---- splittable files -------------------------------------------------------------------------


def _running_state(df: DataFrame, part: list[str], order: str, closed: str, opened: str) -> DataFrame:
    """Quote state after each row, for a start outside (``closed``) and inside (``opened``) quotes.

    Each row maps the state before it to the state after it, given by the columns ``closed`` and
    ``opened``. Such a map keeps the state, flips it, or sets it. After any row the state is that of the
    last setting row, or of the start, flipped once per flipping row since.
    """
    w = W.partitionBy(*part).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    flips = F.sum((F.col(closed) & ~F.col(opened)).cast("int")).over(w) % 2
    df = df.withColumn("_flips", flips)
    set_to = F.when(F.col(closed) == F.col(opened), F.col(closed).cast("int").bitwiseXOR(F.col("_flips")))
    df = df.withColumn("_set", F.last(set_to, ignorenulls=True).over(w))

    def after(start: int) -> Column:
        return F.coalesce("_set", F.lit(start)).bitwiseXOR(F.col("_flips")) == 1

    return df.withColumns({"after_closed": after(0), "after_opened": after(1)}).drop("_flips", "_set")


def _numbered_lines(spark: SparkSession, split: DataFrame) -> DataFrame:
    reader = spark.read.format("text").option("recursiveFileLookup", "true").option("lineSep", "\n")
    # each line keeps its end, so that records can be put together again
    ended = F.split(F.concat("value", F.lit("\n")), r"(?<=\r)(?!\n)")
    # lines of one split are read in order by one task, so seq orders them; a split is bounded in bytes
    w = W.partitionBy("uri", "block").orderBy("seq", "part")

    def number(found: DataFrame, tasks: int | None) -> DataFrame:
        lines = found.select(
            F.col("_metadata.file_path").alias("uri"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            F.is_valid_utf8("value").alias("valid"),  # patterns mend bad bytes, so this comes first
            "value",
        )
        lines = _in_tasks(lines, tasks).select("uri", "block", "seq", "valid", F.posexplode(ended).alias("part", "line"))
        return lines.withColumn("at", F.row_number().over(w) - 1).drop("seq", "part")

    return _staged_reads(spark, reader, split, number, "csv-lines")


def _read_splits(spark: SparkSession, split: DataFrame, max_rows: int) -> DataFrame:
    lines = _numbered_lines(spark, split)
    may_head = (F.col("at") < max_rows) & csv_text.is_header(_without_end(F.col("line")))
    by_block = W.partitionBy("uri").orderBy("block")
    before = by_block.rowsBetween(W.unboundedPreceding, -1)
    blocks = (
        lines.groupBy("uri", "block")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bool_and("valid").alias("valid"),
            F.min(F.when(may_head, F.struct("at", "line"))).alias("found"),
        )
        .withColumn("lines_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    )
    heads = blocks.groupBy("uri").agg(
        F.bool_and("valid").alias("valid"),
        F.min(
            F.when(F.col("found").isNotNull(), F.struct("block", "found", "lines_before"))
        ).alias("first"),
    )
    header_no = F.col("first.lines_before") + F.col("first.found.at")
    heads = heads.select(
        "uri",
        F.when(~F.col("valid"), BAD_TEXT)
        .when(header_no.isNull() | (header_no >= max_rows), NO_HEADER)
        .alias("head_error"),
        F.col("first.block").alias("header_block"),
        F.col("first.found.at").alias("header_at"),
        header_no.alias("header_no"),
        _header_cells(_without_end(F.col("first.found.line"))).alias("header"),
    )
    heads = split.join(heads, "uri", "left").withColumn(
        "head_error", F.when(F.col("header").isNull(), F.coalesce("head_error", F.lit(NO_HEADER)))
        .otherwise(F.col("head_error")),
    )
    heads = stage(heads, "csv-heads")

    good = heads.where(F.col("head_error").isNull()).select(F.col("uri").alias("_uri"), "header_block", "header_at")
    after_header = (F.col("block") > F.col("header_block")) | (
        (F.col("block") == F.col("header_block")) & (F.col("at") > F.col("header_at"))
    )
    body = dimension_join(lines, good, {"_uri": F.col("uri")}, residual=after_header)
    body = body.select("uri", "block", "at", "line")
    bare = _without_end(F.col("line"))
    body = body.withColumns({"_closed": csv_text.ends_open(bare), "_opened": csv_text.stays_open(bare)})
    body = _running_state(body, ["uri", "block"], "at", "_closed", "_opened").drop("_closed", "_opened")

    # state and number of finished records at the start of each split
    ends = body.groupBy("uri", "block").agg(
        F.max_by(F.struct("after_closed", "after_opened"), "at").alias("last"),
        F.count_if(~F.col("after_closed")).alias("ends_if_closed"),
        F.count_if(~F.col("after_opened")).alias("ends_if_opened"),
    )
    ends = ends.select(
        "uri", "block", "ends_if_closed", "ends_if_opened",
        F.col("last.after_closed").alias("_closed"), F.col("last.after_opened").alias("_opened"),
    )
    ends = _running_state(ends, ["uri"], "block", "_closed", "_opened")
    ends = ends.withColumn("starts_open", F.coalesce(F.lag("after_closed").over(by_block), F.lit(False)))
    n_ends = F.when(F.col("starts_open"), F.col("ends_if_opened")).otherwise(F.col("ends_if_closed"))
    ends = ends.withColumn("records_before", F.coalesce(F.sum(n_ends).over(before), F.lit(0)))
    whole_file = by_block.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ends = ends.withColumn("file_open", F.last("after_closed").over(whole_file))
    starts = stage(ends.select("uri", "block", "starts_open", "records_before", "file_open"), "csv-starts")

    w = W.partitionBy("uri", "block").orderBy("at")
    tracked = body.join(starts.where(~F.col("file_open")), ["uri", "block"]).withColumn(
        "open_after", F.when(F.col("starts_open"), F.col("after_opened")).otherwise(F.col("after_closed"))
    )
    finished = F.sum((~F.col("open_after")).cast("bigint")).over(w.rowsBetween(W.unboundedPreceding, -1))
    tracked = tracked.withColumn("record_no", F.col("records_before") + F.coalesce(finished, F.lit(0)))
    pieces = F.array_sort(F.collect_list(F.struct("block", "at", "line")))
    records = tracked.groupBy("uri", "record_no").agg(
        _without_end(F.array_join(F.transform(pieces, lambda p: p["line"]), "")).alias("record")
    )
    records = stage(records.where(~_is_blank(F.col("record"))), "csv-records")

    widths = heads.select(F.col("uri").alias("_uri"), F.size("header").alias("width"))
    faults = (
        dimension_join(records, widths, {"_uri": F.col("uri")})
        .groupBy("uri")
        .agg(F.bool_or(csv_text.n_cells(F.col("record")) > F.col("width")).alias("too_long"))
    )
    never_closed = starts.where("file_open").select("uri", "file_open").distinct()
    row_error = F.when(F.col("file_open"), OPEN_QUOTE).when(F.col("too_long"), LONG_ROW)
    verdict = heads.join(faults, "uri", "left").join(never_closed, "uri", "left").select(
        F.col("uri").alias("_uri"), "path", "header", "header_no",
        F.coalesce("head_error", row_error).alias("error"),
        F.col("too_long").isNull().alias("no_record"),
    )
    verdict = stage(verdict, "csv-verdict")
    kept = (
        dimension_join(records, verdict.where(F.col("error").isNull()), {"_uri": F.col("uri")})
        .withColumn("line_no", (F.col("header_no") + 1 + F.col("record_no")).cast("int"))
        .select(*_OUT)
    )
    without_rows = verdict.where(F.col("error").isNotNull() | F.col("no_record")).select(
        "path",
        "header",
        F.lit(None).cast("int").alias("line_no"),
        F.lit(None).cast("string").alias("record"),
        "error",
    )
    return kept.unionByName(without_rows)
