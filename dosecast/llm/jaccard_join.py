"""Operator 8: self-join of texts by the Jaccard similarity of their five-word shingles, by chosen paths.

Each set of shingles walks down a random tree: at a node it takes every shingle whose hash, seeded by the node, is below
``BRANCHES`` / its size, so about ``BRANCHES`` of them, and two similar sets take a shared one with good probability. Sets that
meet in a node form a bucket. A bucket of at most ``SMALL`` sets is compared in full; a larger one is split by one more
step (``DEPTH`` steps in all); what is still large there is compared in blocks of ``SMALL``, so no bucket is left out. The walk is
repeated with fresh seeds; ``runs_for`` gives the number of runs that reaches the target recall for a pair exactly at the threshold
(more similar pairs are found with higher probability). Candidates are verified on the exact sets.

Documents with the same set are one class first, so copies are never paired. A pair that meets in several buckets is
compared in the least of them alone: each set carries the list of its buckets. Links therefore need no table of pairs: a block of
a bucket gives, for each set, the number of its links and the least set it is connected to there; sums of the first are
the links of a set, and the components of the second are the groups.

What moves: bucket numbers of sets, then texts of those sets alone that have a candidate, once per bucket where they are needed. A
bucket is at most two blocks in one task.

Null and empty texts have no shingles: each is its own class without links. A text of one to four words is one shingle.
Letter case and ASCII white space do not count. Rows without an id take no part (their class is null). Rows that repeat
id and text repeat its result; texts that share an id are told apart, each with links and class of its own. Extra columns are
not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import fresh, id_text, id_type, prepare
from dosecast.llm.components import components
from dosecast.llm.word_hashes import few_at_a_time, hashed, mix
from dosecast.sources.staging import stage

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
BRANCHES = 1.25  # 1 / THRESHOLD: a shared walk of two sets at the threshold goes on with one child on average
DEPTH = 2
SMALL = 512
_WEIGHTS = np.array([0x9E3779B97F4A7C15 * (2 * k + 3) | 1 for k in range(WORDS)], dtype=object)
_WEIGHTS = np.array([int(w) & (1 << 64) - 1 for w in _WEIGHTS], np.uint64)


def runs_for(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``, were all buckets split to the end."""
    meet = 1.0
    for _ in range(DEPTH):
        meet = 1.0 - math.exp(-BRANCHES * threshold * meet)
    return math.ceil(math.log(1.0 - recall) / math.log(1.0 - meet))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, firsts = hashed([t.lower().encode("utf-8", "surrogatepass") for t in texts])
    whole = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        whole += words[k : k + len(whole)] * _WEIGHTS[k]
    whole = mix(whole)
    out = []
    for start, end in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if end - start >= WORDS:
            own = np.sort(whole[start : end - WORDS + 1])
            out.append(own[np.append(True, own[1:] != own[:-1])])
        elif end > start:
            out.append(mix(np.array([(words[start:end] * _WEIGHTS[: end - start]).sum() + np.uint64(end - start)])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _steps(own: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Children of tree nodes for one set: the node each hangs from, and the child."""
    if len(own) <= BRANCHES:
        limit = np.uint64((1 << 64) - 1)
    else:
        limit = np.uint64(int(BRANCHES / len(own) * 2.0**64))
    parents, children = [], []
    step = max(1, (1 << 18) // len(own))
    for at in range(0, len(nodes), step):
        some = nodes[at : at + step]
        found = mix(own[None, :] ^ mix(some)[:, None])
        row, column = np.nonzero(found <= limit)
        parents.append(row + at)
        children.append(mix(some[row] * np.uint64(0xD6E8FEB86659FD93) + own[column]))
    return np.concatenate(parents), np.concatenate(children)


def paths(own: np.ndarray, runs: int) -> tuple[np.ndarray, list[bytes]]:
    """First-level buckets of a set over all runs, and for each its children as 32-bit numbers."""
    seeds = mix(np.arange(1, runs + 1, dtype=np.uint64))
    _, first = _steps(own, seeds)
    if not len(first):
        return first, []
    up, second = _steps(own, first)
    ends = np.cumsum(np.bincount(up, minlength=len(first))).tolist()
    second = second.astype("<u4")
    return first, [second[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _sets(batches: Iterator[pa.RecordBatch], runs: int) -> Iterator[pa.RecordBatch]:
    for batch in few_at_a_time(batches):
        keys, sizes, firsts, belows = [], [], [], []
        for own in shingle_sets(batch.column("text").to_pylist()):
            keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
            first, below = paths(own, runs) if len(own) else (own, [])
            sizes.append(len(first))
            firsts.append(first)
            belows += below
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        first = np.concatenate(firsts) if firsts else np.zeros(0, np.uint64)
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "row_key": batch.column("row_key"),
                "set_key": pa.array(keys, pa.binary()),
                "bucket": pa.ListArray.from_arrays(offsets, pa.array(first.view(np.int64))),
                "below": pa.ListArray.from_arrays(offsets, pa.array(belows, pa.binary())),
            }
        )


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the second level of large buckets."""
    for batch in batches:
        ids, buckets = [], []
        for bucket, below, rep in zip(*(batch.column(c).to_pylist() for c in ("bucket", "below", "rep")), strict=True):
            children = np.frombuffer(below, "<u4").astype(np.uint64)
            nodes = mix(children ^ mix(np.array([bucket]).view(np.uint64)))
            buckets += nodes.view(np.int64).tolist()
            ids += [rep] * len(nodes)
        yield pa.record_batch(
            {"bucket": pa.array(buckets, pa.int64()), "rep": pa.array(ids, batch.schema.field("rep").type)}
        )


def _with_sizes(rows: DataFrame, level: int) -> DataFrame:
    """Rows of buckets of two sets and more, with the size of the bucket, written once."""
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return stage(rows.join(sizes.hint("merge"), "bucket"), f"buckets-{level}")


def _leaves(sets: DataFrame, kind: str) -> DataFrame:
    """bucket, size, rep of all buckets to compare."""
    first = sets.select(F.explode(F.arrays_zip("bucket", "below")).alias("x"), "rep")
    first = _with_sizes(first.select("x.bucket", "x.below", "rep"), 1)
    small = first.where(F.col("size") <= SMALL).select("bucket", "size", "rep")
    large = first.where(F.col("size") > SMALL).select("bucket", "below", "rep")
    return small.unionByName(_with_sizes(large.mapInArrow(_split, f"bucket bigint, rep {kind}"), 2))


def _blocks(leaves: DataFrame) -> DataFrame:
    """One row per set, bucket and pair of blocks of the bucket: bucket, low, high, side, rep and all buckets of the set."""
    own = leaves.groupBy("rep").agg(F.sort_array(F.collect_set(F.struct("bucket", "size"))).alias("own"))
    each = own.select("rep", F.col("own.bucket").alias("buckets"), F.explode("own").alias("x"))
    n = F.ceil(F.col("x.size") / SMALL).cast("int")
    each = each.select("rep", "buckets", "x.bucket", n.alias("n")).withColumn(
        "side", F.pmod(F.xxhash64("rep"), F.col("n")).cast("int")
    )
    other = each.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return other.select(
        "bucket", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "rep", "buckets"
    )


_GROUP = ("bucket", "low", "high")


def _together(rows: DataFrame) -> DataFrame:
    """The rows of a pair of blocks in one task, next to each other. It is ``2 * SMALL`` sets or so at most."""
    return rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "rep")


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    key, rows = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*_GROUP, *names)]
        for row in zip(*columns, strict=True):
            if row[:3] != key:
                if rows:
                    yield key, rows
                key, rows = row[:3], []
            if not rows or rows[-1][0] != row[3]:  # names begin with rep, so a repeated one follows itself
                rows.append(row[3:])
    if rows:
        yield key, rows


def _first_meetings(key: tuple, sides: list[int], buckets: list[list[int]]) -> list[tuple[int, int]] | np.ndarray:
    """Pairs of rows of a group that meet in no lesser bucket, as a boolean matrix of the upper triangle."""
    count = len(sides)
    bucket, low, high = key
    side = np.array(sides)
    wanted = np.triu(np.ones((count, count), bool), 1)
    if low != high:
        wanted &= side[:, None] != side[None, :]
    earlier = [[b for b in own if b < bucket] for own in buckets]
    if count <= 8:
        known = [set(e) for e in earlier]
        for i in range(count):
            for j in range(i + 1, count):
                if wanted[i, j] and not known[i].isdisjoint(known[j]):
                    wanted[i, j] = False
        return wanted
    flat = np.array([b for e in earlier for b in e], np.int64)
    rows = np.repeat(np.arange(count), [len(e) for e in earlier])
    return wanted & ~(_shared(flat, rows, count) > 0)


def _shared(flat: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Number of values that each two rows share; a row holds a value once."""
    out = np.zeros((count, count), np.float32)
    values, where, times = np.unique(flat, return_inverse=True, return_counts=True)
    keep = times[where] > 1  # values of one row cannot be shared
    number = np.cumsum(times > 1) - 1
    columns, rows = number[where[keep]], rows[keep]
    order = np.argsort(columns, kind="stable")
    columns, rows = columns[order], rows[order]
    width = 4096
    for at in range(0, int(columns[-1]) + 1 if len(columns) else 0, width):
        a, b = np.searchsorted(columns, [at, at + width])
        held = np.zeros((count, width), np.float32)
        held[rows[a:b], columns[a:b] - at] = 1.0
        out += held @ held.T
    return out


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sets that have some pair to compare in their group."""
    types = {}

    def checked():
        for batch in batches:
            types.update({f.name: f.type for f in batch.schema})
            yield batch

    out = []
    for key, rows in _groups(checked(), ("rep", "side", "buckets")):
        if len(rows) > 1:
            wanted = _first_meetings(key, [r[1] for r in rows], [r[2] for r in rows])
            has = wanted.any(axis=0) | wanted.any(axis=1)
            out += [(*key, *row) for row, needed in zip(rows, has.tolist(), strict=True) if needed]
        if len(out) > 5000:
            yield _batch(out, types)
            out = []
    if out:
        yield _batch(out, types)


def _batch(rows: list[tuple], types: dict) -> pa.RecordBatch:
    names = (*_GROUP, "rep", "side", "buckets")
    return pa.record_batch({n: pa.array([r[i] for r in rows], types[n]) for i, n in enumerate(names)})


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """rep, its number of links in a group, and the least set that it is connected to there."""
    kind, out = None, []

    def checked():
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field("rep").type
            yield batch

    def record():
        return pa.record_batch(
            {
                "rep": pa.array([r[0] for r in out], kind),
                "least": pa.array([r[1] for r in out], kind),
                "n_links": pa.array([r[2] for r in out], pa.int64()),
            }
        )

    for key, rows in _groups(checked(), ("rep", "side", "buckets", "text")):
        if len(rows) < 2:
            continue
        sets = shingle_sets([r[3] or "" for r in rows])
        links = _links(_first_meetings(key, [r[1] for r in rows], [r[2] for r in rows]), sets, threshold)
        if links.any():
            links = links | links.T
            least = _least(links)
            degree = links.sum(axis=0).tolist()
            out += [(r[0], rows[least[i]][0], degree[i]) for i, r in enumerate(rows) if degree[i]]
        if len(out) > 5000:
            yield record()
            out = []
    if out:
        yield record()


def _links(wanted: np.ndarray, sets: list[np.ndarray], threshold: float) -> np.ndarray:
    sizes = np.array([len(s) for s in sets])
    small, large = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
    wanted = wanted & (small >= threshold * large - 1e-9)  # sizes alone rule most false candidates out
    if len(sets) <= 8:
        shared = np.zeros(wanted.shape)
        for i, j in zip(*np.nonzero(wanted), strict=True):
            shared[i, j] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        shared = _shared(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets))
    union = sizes[:, None] + sizes[None, :] - shared
    return wanted & (shared >= threshold * union - 1e-9)


def _least(links: np.ndarray) -> np.ndarray:
    """Least row connected to each row; rows are in the order of their ids."""
    label = np.arange(len(links))
    while True:
        near = np.where(links, label[None, :], len(links)).min(axis=1)
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _row_key() -> Column:
    """16 bytes that stand for id and text together, so that texts under one id stay apart."""
    return F.unhex(F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.md5("text"))))


def _classified(docs: DataFrame, threshold: float, recall: float) -> DataFrame:
    """doc_id and row_key of each row, ``first`` of its copies and ``lead`` of its group (id and row key), n_copies, n_links."""
    prepare(docs.sparkSession)
    kind, runs = id_type(docs), runs_for(threshold, recall)
    schema = f"doc_id {kind}, row_key binary, set_key binary, bucket array<bigint>, below array<binary>"
    keyed = id_text(docs).withColumn("row_key", F.when(F.col("doc_id").isNotNull(), _row_key()))
    made = stage(keyed.mapInArrow(lambda batches: _sets(batches, runs), schema), "sets")
    row = F.struct("doc_id", "row_key")
    classes = (
        made.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min(row).alias("first"), F.count("*").alias("n_copies"))
        .withColumn("rep", F.col("first.row_key"))
    )
    sets = made.join(classes.hint("merge"), F.col("row_key") == F.col("rep")).select("rep", "bucket", "below")
    one = "bucket bigint, low int, high int"
    rows = _together(_blocks(_leaves(sets, "binary")))
    needed = rows.mapInArrow(_needed, f"{one}, rep binary, side int, buckets array<bigint>")
    texts = keyed.where("doc_id IS NOT NULL").select("row_key", "text")
    held = needed.join(texts.hint("merge"), F.col("rep") == F.col("row_key")).drop("row_key")
    found = _together(held).mapInArrow(
        lambda batches: _verify(batches, threshold), "rep binary, least binary, n_links bigint"
    )
    found = stage(found, "links")
    n_links = found.groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("least").alias("b"))).withColumnRenamed("node", "rep")
    leads = groups.join(classes.select("rep", "first").hint("merge"), "rep").groupBy("component")
    leads = groups.join(leads.agg(F.min("first").alias("lead")).hint("merge"), "component").select("rep", "lead")
    known = classes.join(n_links.hint("merge"), "rep", "left").join(leads.hint("merge"), "rep", "left").drop("rep")
    out = made.select("doc_id", "row_key", "set_key").join(known.hint("merge"), "set_key", "left")
    first = F.coalesce("first", row)
    return out.select(
        "doc_id", "row_key", first.alias("first"), F.coalesce("lead", first).alias("lead"), "n_copies", "n_links"
    )


def similar_texts(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (least id of its group of linked texts), copy_of (least id with the same set), n_copies and n_links.

    ``n_links`` counts different sets with a similarity of ``threshold`` or more; all copies of a text have it.
    """
    known = F.col("doc_id").isNotNull()
    return _classified(docs, threshold, recall).select(
        "doc_id",
        F.when(known, F.col("lead.doc_id")).alias("class_id"),
        F.when(known, F.col("first.doc_id")).alias("copy_of"),
        F.when(known, F.coalesce("n_copies", F.lit(1))).otherwise(1).cast("bigint").alias("n_copies"),
        F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows whose id and text are the least of their group; rows without an id stay, repeated rows stay together.

    An id with several texts loses only those that a lesser row stands for.
    """
    found = _classified(docs.select("doc_id", "text"), threshold, recall)
    name = fresh(docs, "other_row")
    others = found.where("doc_id IS NOT NULL AND row_key <> lead.row_key").select(F.col("row_key").alias(name)).distinct()
    return docs.join(others.hint("merge"), _row_key() == F.col(name), "left_anti")
