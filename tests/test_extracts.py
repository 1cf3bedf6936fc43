from pathlib import Path

from pyspark.sql import functions as F

from dosecast.workload import curation_queries as cq
from dosecast.workload import extracts


def files_below(root):
    """{folders of a file: its text}; Spark's checksums and markers left out."""
    root = Path(root.removeprefix("file:"))
    return {str(f.parent.relative_to(root)): f.read_bytes() for f in root.rglob("part-*")}


def test_many_small_files_are_dealt_over_tasks(spark, tmp_path, monkeypatch):
    spark.range(600).select(
        F.col("id").alias("s_suppkey"), F.concat(F.lit("Supplier "), "id").alias("s_name"), F.lit(1).alias("s_nationkey")
    ).write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(extracts, "FILES_PER_TASK", 20, raising=False)
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    context.setJobGroup("small files", "small files")
    try:
        root = extracts.faulty_extracts(spark, str(tmp_path))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    last = max(tracker.getJobIdsForGroup("small files"))
    assert max(tracker.getStageInfo(s).numTasks for s in tracker.getJobInfo(last).stageIds) >= 30
    written = files_below(root)
    assert len(written) == 600
    assert written["extract=20240201/folder=folder 5/name=Acme AA-BB-5-1_5 Site SupplyMethod.csv"].splitlines()[1:] == [
        b"Land,5,Supplier 5,central,Open"
    ]
    rejected = cq.rejected_files(spark, str(tmp_path))
    assert {r["error"]: r["count"] for r in rejected.groupBy("error").count().collect()} == {
        e: 120 for e in (cq.conform.NO_STUDY, cq.NO_HEADER, cq.OPEN_QUOTE, cq.LONG_ROW)
    }


def test_small_files_are_those_of_the_text_writer(spark):
    odd = ['a "b"', "50%", "x:y=z", "it's #1?", "[c]{d}^*\\e", "é\t", None, "plain"]
    lines = [(10, "line 10"), (2, 'line 2, "é"'), (8, None), (None, "first"), (3, "")]
    rows = [("20240201", folder, name, *line) for folder in odd for name in [*odd[:-2], ""] for line in lines]
    df = spark.createDataFrame(rows, "extract string, folder string, name string, ord bigint, line string")
    small, text = (files_below(make(df, "files")) for make in (extracts.write_small, extracts.write))
    assert set(small.values()) == {'first\nline 2, "é"\n\n\nline 10\n'.encode()}
    assert {f: sorted(t.splitlines()) for f, t in small.items()} == {f: sorted(t.splitlines()) for f, t in text.items()}
