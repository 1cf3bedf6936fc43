"""Each stage of the pipeline on the rows that the one before it kept."""

from collections import Counter

import __spark_entry__ as contract
import corpus_pipeline
from dosecast.llm import bpe, decontaminate, jaccard_join, pii, quality_rules
from dosecast.llm.queries import trusted_ids


def test_registered():
    names = contract.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, now = docs.columns, docs
    held = []
    for _, step in corpus_pipeline.STAGES[:-1]:
        now = step(spark, now, sf)
        assert now.columns == columns
        held.append({r.doc_id: r.text for r in now.collect()})
        now = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in held[-1].items()], docs.schema)
    good, single, clean, private = held
    facts = {r.doc_id: r.kept for r in quality_rules.rules(docs, trusted_ids(spark, sf)).collect()}
    assert set(good) == {i for i, kept in facts.items() if kept} and good
    rows = lambda texts: spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id bigint, text string")
    groups = jaccard_join.similar_texts(rows(good)).collect()
    assert set(single) == {r.class_id for r in groups}
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    hit = {r.doc_id for r in decontaminate.report(rows(single), bench).where("contaminated").collect()}
    assert set(clean) == set(single) - hit
    found = {r.doc_id: r.spans for r in pii.report(rows(clean)).collect()}
    assert all((private[i] != clean[i]) == bool(found[i]) for i in clean)
    assert pii.report(rows(private)).where("n_email + n_ip + n_card + n_phone > 0").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, now, sf)
    assert sorted(last.collect()) == sorted(bpe.digests(rows(private)).collect())


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_odd_tables(spark, sf):
    """Nulls, empty and long texts, repeated rows and ids, clashing extra columns; then no rows at all."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first, other = [" ".join(f"{w}{i}" for i in range(90)) for w in ("first", "other")]
    odd = [(1, first), (1, first), (2, first), (3, other + " tail"), (3, first + " end"), (None, other), (4, None), (5, ""),
           (None, None), (6, (other + "\n") * 60), (7, "x" * 50000)]
    far = 10**9  # beyond the ids of the given documents, whose labels are the trusted target
    names = "doc_id bigint, text string, bucket string, size string, rep string, kept string, row_key string, label string"
    now = spark.createDataFrame([(None if i is None else i + far, t, *"abcdef") for i, t in odd], names).union(
        docs.selectExpr("doc_id", "text", *[f"'{v}'" for v in "abcdef"])
    )
    empty = now.where("false")
    ids = []
    for _, step in corpus_pipeline.STAGES[:-1]:
        # each stage has the odd rows whole: which of them the rules keep depends on the trusted texts
        out, none = step(spark, now, sf), step(spark, empty, sf)
        assert out.columns == none.columns == now.columns and none.count() == 0
        rows = out.collect()
        assert all(tuple(r[2:]) == tuple("abcdef") for r in rows)
        ids.append([r.doc_id and r.doc_id - far for r in rows if r.doc_id is None or r.doc_id > far])
    rules, single, clean, private = ids
    assert not {4, 5, 7} & set(rules) and rules.count(1) in (0, 2)
    assert single.count(1) == 2 and single.count(None) == 2 and single.count(3) == 1 and {4, 5, 7} <= set(single) and 2 not in single
    assert Counter(clean) == Counter(private) == Counter(i for i, _ in odd)
    assert corpus_pipeline.token_digests(spark, empty, sf).count() == 0
    assert corpus_pipeline.token_digests(spark, now, sf).count() == now.count()
