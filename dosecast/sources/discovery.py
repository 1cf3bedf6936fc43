"""Which files to read: date folders, study folders, file kinds, latest versions.

``<root>/<yyyymmdd>/<study folder>/<file>.csv`` is the default layout. Everything but ``list_files`` and
``chosen_folder_names`` works on any DataFrame with ``path`` and ``modificationTime``.
"""

from __future__ import annotations

import datetime as dt
import os
import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import chain, islice

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from dosecast.fixed_values import FILE_KINDS
from dosecast.functions import text
from dosecast.sources.staging import stage_all

#: Files, or children of a date folder, that one reader is given: the driver holds all files of a reader.
GROUP_FILES = 10_000
#: What a task reads, where a file counts as ``FILE_BYTES`` at least.
TASK_BYTES = 128 * 1024 * 1024
FILE_BYTES = 512 * 1024
_GLOB = set("*?[]{}\\")


@dataclass(frozen=True)
class Layout:
    """``pattern`` finds date folder, study folder (may be empty) and file name in a path.

    ``folder`` builds the directory of a date folder below the root. ``named_files`` says that the name
    is that of the file itself, so a listing can be narrowed by it.
    """

    pattern: str = r"/(\d+)/(?:([^/]+)/)?([^/]+)$"
    folder: str = "{}"
    named_files: bool = True


@dataclass(frozen=True)
class FolderChoice:
    """Latest folder only, or (``historical``) all folders between optional, inclusive bounds."""

    historical: bool = False
    start: dt.date | None = None
    end: dt.date | None = None


def kind_glob(kind: str) -> str:
    """Glob for file names that may be of a kind, in any case of letters."""

    def any_case(word: str) -> str:
        return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)

    words = [any_case(w) for w in FILE_KINDS[kind]]
    orders = [words, words[::-1]] if len(words) > 1 else [words]
    end = any_case(".csv")
    return "{" + ",".join("*" + "*".join(o) + "*" + end for o in orders) + "}"


def exactly(path: str) -> str:
    """A pattern that only ``path`` itself fits."""
    return "".join(f"\\{c}" if c in _GLOB else c for c in path)


@contextmanager
def _light_listing(spark: SparkSession) -> Iterator[None]:
    """Readers made inside list with few tasks (else one for each path named) and leave no listing behind in the driver's cache."""
    wanted = {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism),
        "spark.sql.hive.manageFilesourcePartitions": "false",
    }
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def load_group(spark: SparkSession, reader: DataFrameReader, paths: list[str]) -> DataFrame:
    """What ``reader`` makes of one group of paths, given as patterns."""
    # ``reader.load`` would send each path to Java by a call of its own, which takes longer than reading small files
    names = spark._jvm.java.util.regex.Pattern.compile("\n").split("\n".join(paths))
    with _light_listing(spark):
        if len(names) != len(paths):  # a name holds a line feed
            return reader.load(paths)
        return DataFrame(reader._jreader.load(names), spark)


def file_groups(files: DataFrame) -> Iterator[tuple[list[str], int]]:
    """The distinct paths of ``files``, a group at a time, and in how many tasks to read each group.

    They come by way of the driver, which holds one group. Without a column ``length`` a file may have a task of its own.
    """
    length = F.greatest("length", F.lit(FILE_BYTES)) if "length" in files.columns else F.lit(TASK_BYTES)
    files = files.groupBy("path").agg(F.max(length).alias("cost"))
    parts = files.repartition(-(-files.count() // GROUP_FILES) or 1, "path")
    rows = parts.toLocalIterator()
    while group := list(islice(rows, GROUP_FILES)):
        yield [exactly(r["path"]) for r in group], -(-sum(r["cost"] for r in group) // TASK_BYTES)


def _hidden(name: str) -> bool:
    """Names that Spark's listing passes over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _children(spark: SparkSession, path: str) -> Iterator[str]:
    """Patterns of the children of a folder, in no order; of anything else, ``path`` itself."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if set(path) & _GLOB or not system.isDirectory(at):
        yield path
    elif system.getUri().getScheme() == "file":
        # Hadoop's local file system makes a list of all
        with os.scandir(system.makeQualified(at).toUri().getPath()) as entries:
            names = (entry.name for entry in entries)
            yield from (exactly(f"{path.rstrip('/')}/{name}") for name in names if not _hidden(name))
    else:
        entries = system.listStatusIterator(at)
        while entries.hasNext():
            child = entries.next().getPath()
            if not _hidden(child.getName()):
                yield exactly(child.toString())


def list_files(spark: SparkSession, *paths: str, glob: str | None = None) -> DataFrame:
    """Path, modification time and size of all files below ``paths``; contents stay unread.

    Beyond ``GROUP_FILES`` children (study folders, say) these are listed by groups, each written before the next.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    columns = ["path", "modificationTime", "length"]
    children = chain.from_iterable(_children(spark, path) for path in paths)
    first = list(islice(children, GROUP_FILES + 1))
    if len(first) <= GROUP_FILES:
        return reader.load(list(paths)).select(columns)
    children = chain(first, children)
    del first
    groups = iter(lambda: list(islice(children, GROUP_FILES)), [])
    tasks = -(-GROUP_FILES * FILE_BYTES // TASK_BYTES)
    return stage_all((load_group(spark, reader, group).select(columns).coalesce(tasks) for group in groups), "listed-files")


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def describe(files: DataFrame, layout: Layout = Layout(), root: str | None = None) -> DataFrame:
    """Add date folder, extract date, study folder, name and kind; files outside the layout go.

    With ``root`` the layout begins there, whatever the root's own folders are called; without, at the first folder
    that fits.
    """
    path, start = F.col("path"), "(?s)^.*?"
    if root is not None:
        above = re.sub(_SCHEME, "", root).rstrip("/")
        bare = F.regexp_replace("path", _SCHEME, "")
        path = F.when(F.startswith(bare, F.lit(above + "/")), F.substr(bare, F.lit(len(above) + 1)))
        start = "(?s)^"
    parts = F.split(F.regexp_replace(path, start + layout.pattern, "$1\n$2\n$3"), "\n")

    def details(part: Column) -> Column:
        folder, name = part[0], part[2]
        return F.struct(
            folder.alias("date_folder"),
            part[1].alias("study_folder"),
            name.alias("name"),
            F.when(F.length(folder) == 8, F.try_to_date(folder, "yyyyMMdd")).alias("extract_date"),
            text.file_kind(F.lower(name)).alias("kind"),
        )

    # lambdas bind the parts once; a filter on them would be pushed down and repeat the patterns
    fitting = F.filter(F.array(parts), lambda part: F.size(part) == 3)
    dated = F.filter(F.transform(fitting, details), lambda file: file["extract_date"].isNotNull())
    return files.withColumn("_file", F.explode(dated)).select(*files.columns, "_file.*")


def date_folders(files: DataFrame) -> DataFrame:
    """Valid date folders, oldest first."""
    return files.select("date_folder", "extract_date").distinct().orderBy("extract_date")


def choose_folders(files: DataFrame, choice: FolderChoice = FolderChoice()) -> DataFrame:
    """Files of the chosen date folders."""
    if not choice.historical:
        return files.where(F.col("extract_date") == files.agg(F.max("extract_date")).scalar())
    if choice.start:
        files = files.where(F.col("extract_date") >= F.lit(choice.start))
    if choice.end:
        files = files.where(F.col("extract_date") <= F.lit(choice.end))
    return files


def chosen_folder_names(
    spark: SparkSession, root: str, choice: FolderChoice = FolderChoice(), layout: Layout = Layout()
) -> list[str]:
    """Names of the chosen date folders below ``root``, oldest first. None is an error.

    Only the children of the root are listed, so the cost does not depend on what older folders hold. A folder
    counts even if it is empty.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    children = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    before, after = layout.folder.split("{}")
    fits = re.compile(re.escape(before) + r"([0-9]{8})" + re.escape(after))
    dated = []
    for child in children:
        found = fits.fullmatch(child.getPath().getName())
        if found and child.isDirectory():
            try:
                dated.append((dt.datetime.strptime(found[1], "%Y%m%d").date(), found[1]))
            except ValueError:
                continue  # eight digits that are no day
    if choice.historical:
        first, last = choice.start or dt.date.min, choice.end or dt.date.max
        dated = [d for d in dated if first <= d[0] <= last]
    else:
        dated = sorted(dated)[-1:]
    if not dated:
        raise ValueError("no valid date folders")
    return [name for _, name in sorted(dated)]


def latest_files(files: DataFrame) -> DataFrame:
    """Per date folder, study folder and kind the file modified last; the first path on equal times.

    Only files in a study folder count. One ``min`` over a struct, which combines on the map side, so a folder with very
    many files is a row per task. A struct with text makes it a sort aggregate: each task sorts its own rows by folder.
    """
    age = -F.unix_micros(F.col("modificationTime").cast("timestamp"))
    others = [c for c in files.columns if c not in ("date_folder", "extract_date", "study_folder", "kind", "path")]
    return (
        files.where(F.col("kind").isNotNull() & (F.col("study_folder") != ""))
        .groupBy("date_folder", "extract_date", "study_folder", "kind")
        .agg(F.min(F.struct(age.alias("age"), "path", *others)).alias("file"))
        .select("date_folder", "extract_date", "study_folder", "kind", "file.path", *[f"file.{c}" for c in others])
    )


def all_files(files: DataFrame) -> DataFrame:
    """Every file of a known kind, in study folders and in the date folder itself."""
    return files.where(F.col("kind").isNotNull())
