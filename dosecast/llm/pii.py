"""Operator 7: personal data by patterns, and by contexts bootstrapped from them.

The base finds four kinds of data by the contract's patterns. They are matched as leftmost runs of one character class each:
where a pattern repeats a group, characters that cannot be inside a match are first replaced one for one, so that no
regular expression recurses over a long text. Positions are the sums of the lengths of gaps and matches.

The method starts from those entities. Each mention gives three lexical patterns, the two words to its left, the
words on both sides, and a label (a word that ends with a colon, an equals or a number sign) right before it. Looser candidates
(tokens shaped like the kind that the base did not take, with and without single blanks between groups of digits) give
theirs; a number that could be a card or a phone is a candidate for both, and of overlapping ones at one start the longest stands. Patterns and
instances form a graph: a pattern is as good as the mean of its instances, drawn to zero by ``DOUBT`` doubtful ones; an
instance that no base match supports is as good as its patterns together (noisy or). After ``ROUNDS`` rounds, patterns of at
least ``CONFIDENCE`` with ``SUPPORT`` distinct known instances name the candidates in their place as identifiers; all their
mentions become new spans, where these do not overlap another span. The graph is one row per pattern and instance, counted before it is shuffled.

Null and empty texts have no data. Repeated rows give the same spans each; they count as one mention each. Null ids are kept.
Extra columns pass through ``redact`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import fresh
from dosecast.operators.joins import dimension_join
from dosecast.sources.staging import stage

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
CONFIDENCE = 0.8
SUPPORT = 3
DOUBT = 0.5
CONTEXT_CHARS = 80  # tried first; a context that does not end within them is read as far as it goes
SPAN = "struct<start: int, end: int, kind: int>"
# three words before a place, or fewer where the text begins; tried at starts of words alone, and without going back
_LAST_WORDS = r"(?:(?<!\S)\S++\s*+){0,3}$"
# fixed values of the contract: character classes of its patterns
_LOCAL, _LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"


def _runs(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: struct(start, end, hit), positions in code points."""
    both = rf"(?s)\G(.*?)({pattern})"  # tied to the end of the last match: no new start after the last one
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(both), F.lit(1)).alias("gap"),
        F.regexp_extract_all(text, F.lit(both), F.lit(2)).alias("hit"),
    )
    empty = F.array().cast("array<struct<start: int, end: int, hit: string>>")

    def step(done: Column, pair: Column) -> Column:
        start = F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(0)) + F.length(pair["gap"])
        hit = F.struct(start.alias("start"), (start + F.length(pair["hit"])).alias("end"), pair["hit"].alias("hit"))
        return F.concat(done, F.array(hit))

    return F.aggregate(pairs, empty, step)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(digit: Column, i: Column) -> Column:
        n = digit.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(n > 9, n - 9).otherwise(n)

    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""), value)
    return F.aggregate(each, F.lit(0), lambda s, x: s + x) % 10 == 0


def base_spans(text: Column) -> Column:
    """array of struct(start, end, kind) of the contract's matches, by start, then kind."""
    filled = F.coalesce(text, F.lit(""))
    # a dot that no label surrounds cannot be in a domain; as "_" it still can be in the local part
    dots = F.regexp_replace(filled, rf"\.(?![{_LABEL}])|(?<![{_LABEL}])\.", "_")
    email = _runs(dots, rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++\.[A-Za-z0-9.-]++")
    ip = _runs(filled, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
    # a blank or hyphen that is not between two digits ends a card number
    single = F.regexp_replace(filled, r"[ -](?![0-9])|(?<![0-9])[ -]", "\n")
    card = _runs(single, r"(?<![0-9 -])[0-9][0-9 -]++")
    phone = _runs(filled, r"\+[0-9][ ().0-9-]+[0-9]")
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
    n_digits = lambda x: F.length(_digits(x["hit"]))
    good = {
        "email": (F.contains(filled, F.lit("@")), email, lambda x: F.lit(True)),
        "ip": (F.rlike(filled, F.lit(r"[0-9]\.[0-9]")), ip, lambda x: F.rlike(x["hit"], F.lit(rf"^{part}(?:\.{part}){{3}}$"))),
        "card": (
            F.rlike(filled, F.lit(r"[0-9][ -]?[0-9]")),
            card,
            lambda x: n_digits(x).between(14, 19) & _luhn(_digits(x["hit"])),
        ),
        "phone": (F.rlike(filled, F.lit(r"\+[0-9]")), phone, lambda x: n_digits(x).between(10, 15)),
    }
    empty = F.array().cast(f"array<{SPAN}>")
    found = []
    for number, kind in enumerate(KINDS):
        possible, runs, valid = good[kind]
        spans = F.transform(F.filter(runs, valid), _as_kind(number))
        found.append(F.when(possible, spans).otherwise(empty))
    return _in_order(F.concat(*found))


def _as_kind(number: int):
    return lambda x: F.struct(x["start"], x["end"], F.lit(number).alias("kind"))


def _is_kind(number: int):
    return lambda x: x["kind"] == number


def _in_order(spans: Column) -> Column:
    keyed = F.transform(spans, lambda x: F.struct(x["start"].alias("s"), x["kind"].alias("k"), x["end"].alias("e")))
    return F.transform(
        F.array_sort(keyed), lambda x: F.struct(x["s"].alias("start"), x["e"].alias("end"), x["k"].alias("kind"))
    )


def loose_spans(text: Column) -> Column:
    """Tokens shaped like one of the kinds, whatever the base makes of them."""
    filled = F.coalesce(text, F.lit(""))
    # a blank that does not stand alone between groups of digits ends a number
    single = F.regexp_replace(filled, r" (?![0-9(])|(?<![0-9)]) ", "\n")
    at = _runs(filled, r"(?<![^\s@])[^\s@]++@[^\s@]++")
    before = "(?<![0-9A-Za-z().+-])[+(]?[0-9]"
    numbers = F.concat(_runs(filled, before + "[().0-9-]{5,}+"), _runs(single, before + "[ ().0-9-]{5,}+"))
    bare = F.array_distinct(F.transform(numbers, _without_edges))

    def of(number: int, good):
        return F.transform(F.filter(bare, good), _as_kind(number))

    dotted = lambda x: F.rlike(x["hit"], F.lit(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"))
    n_digits = lambda x: F.length(_digits(x["hit"]))
    empty = F.array().cast(f"array<{SPAN}>")
    emails = F.transform(F.transform(at, lambda x: _ends(x, F.regexp_replace(x["hit"], r"[.,;:!?)>\]}\"']+$", ""))), _as_kind(0))
    others = F.concat(
        of(1, dotted),
        of(2, lambda x: ~dotted(x) & n_digits(x).between(13, 19)),
        of(3, lambda x: ~dotted(x) & n_digits(x).between(7, 15)),
    )
    return F.concat(
        F.when(F.contains(filled, F.lit("@")), emails).otherwise(empty),
        F.when(F.rlike(filled, F.lit("[0-9][ ().0-9-]{5}")), others).otherwise(empty),
    )


def _ends(x: Column, hit: Column) -> Column:
    """A match that is cut at its end to ``hit``."""
    return F.struct(x["start"].alias("start"), (x["start"] + F.length(hit)).alias("end"), hit.alias("hit"))


def _without_edges(x: Column) -> Column:
    """A number up to its last digit, without a bracket that opens and does not close."""
    cut = F.regexp_replace(x["hit"], "[^0-9]+$", "")
    extra = F.when(F.startswith(cut, F.lit("(")) & ~F.contains(cut, F.lit(")")), 1).otherwise(0)
    return F.struct(
        (x["start"] + extra).alias("start"), (x["start"] + F.length(cut)).alias("end"), F.substring(cut, extra + 1, F.length(cut)).alias("hit")
    )


def _mention(text: Column, span: Column, known: bool) -> Column:
    """What the graph needs of a span: its place, its text and its lexical patterns."""
    low = F.greatest(F.lit(0), span["start"] - CONTEXT_CHARS)
    near = F.regexp_replace(F.substring(text, low + 1, span["start"] - low), r"\($", "")  # a bracket around the span is no word
    # blanks that end before the window does show that two words stand whole in it
    whole = (low == 0) | F.rlike(near, F.lit(r"\s\S+\s+\S+\s*$"))
    before = F.regexp_replace(F.substring(text, F.lit(1), span["start"]), r"\($", "")
    left = F.lower(F.when(whole, near).otherwise(F.regexp_extract(before, _LAST_WORDS, 0)))
    near = F.substring(text, span["end"] + 1, F.lit(CONTEXT_CHARS))
    whole = (F.length(near) < CONTEXT_CHARS) | F.rlike(near, F.lit(r"^\s*\S+\s"))
    right = F.lower(F.when(whole, near).otherwise(F.regexp_extract(F.substr(text, span["end"] + 1), r"^\s*+\S*+", 0)))
    two = F.regexp_extract(left, r"(?<!\S)\S++\s++\S++\s++$", 0)
    one = F.regexp_extract(left, r"(?<!\S)(\S++)\s++$", 1)
    after = F.regexp_extract(right, r"^\s+(\S+)", 1)
    label = F.regexp_extract(left, r"(?<![^\s:=#])([^\s:=#]++[:=#])\s*+$", 1)
    folded = F.regexp_replace(F.trim(two), r"\s+", " ")
    return F.struct(
        span["start"].alias("start"),
        span["end"].alias("end"),
        span["kind"].alias("kind"),
        F.lit(known).alias("known"),
        F.substring(text, span["start"] + 1, span["end"] - span["start"]).alias("instance"),
        F.array(
            F.when(two != "", F.concat(folded, F.lit(" _"))),
            F.when((one != "") & (after != ""), F.concat(one, F.lit(" _ "), after)),
            F.when(label != "", F.concat(label, F.lit(" _"))),
        ).alias("patterns"),
    )


def facts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, text_hash, base spans and mentions per document row; written once, without the texts."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    rows = rows.withColumn("base", base_spans(F.col("_text"))).withColumn("loose", loose_spans(F.col("_text")))
    new = F.filter("loose", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"])))
    mentions = F.concat(
        F.transform("base", lambda x: _mention(text, x, True)), F.transform(new, lambda x: _mention(text, x, False))
    )
    return stage(rows.select("doc_id", F.xxhash64(text).alias("text_hash"), "base", mentions.alias("mentions")), "mentions")


def new_spans(found: DataFrame) -> DataFrame:
    """doc_id, text_hash and the spans that high-confidence patterns add, of rows of ``facts``."""
    mentions = found.select("doc_id", "text_hash", F.explode("mentions").alias("m")).select(
        "doc_id", "text_hash", "m.*", F.explode("m.patterns").alias("pattern")
    )
    mentions = mentions.where("pattern IS NOT NULL")
    # a known mention of an instance makes the instance known everywhere
    edges = mentions.groupBy("kind", "pattern", "instance").agg(F.max("known").alias("known"))
    scored = stage(edges.withColumn("score", F.col("known").cast("double")), "graph")
    for _ in range(ROUNDS):
        good = _pattern_scores(scored).select("kind", "pattern", "confidence")
        reached = scored.drop("score").join(good.hint("merge"), ["kind", "pattern"])
        doubt = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999999))))
        instances = reached.groupBy("kind", "instance").agg(
            F.max("known").alias("seed"), (1 - F.exp(doubt)).alias("likely")
        )
        score = F.when(F.col("seed"), 1.0).otherwise(F.col("likely"))
        scored = scored.drop("score").join(
            instances.select("kind", "instance", score.alias("score")).hint("merge"), ["kind", "instance"]
        )
        scored = stage(scored.select("kind", "pattern", "instance", "known", "score"), "graph")
    good = _pattern_scores(scored).where((F.col("confidence") >= CONFIDENCE) & (F.col("support") >= SUPPORT))
    unseen = scored.where("NOT known").join(good.select("kind", "pattern").hint("merge"), ["kind", "pattern"], "left_semi")
    unseen = unseen.select("kind", "instance").distinct()
    taken = mentions.where("NOT known").join(unseen.hint("merge"), ["kind", "instance"], "left_semi")
    return taken.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("start", "end", "kind")).alias("added")
    )


def _pattern_scores(scored: DataFrame) -> DataFrame:
    return scored.groupBy("kind", "pattern").agg(
        (F.sum("score") / (F.count("*") + DOUBT)).alias("confidence"),
        F.sum(F.col("known").cast("int")).alias("support"),
    )


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base and all spans per document row."""
    found = facts(docs)
    added = new_spans(found).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("added").alias("_added")
    )
    joined = dimension_join(
        found.drop("mentions"), stage(added, "added"), {"_id": F.col("doc_id"), "_hash": F.col("text_hash")}, "left"
    )
    return joined.select("doc_id", "base", _all_spans(F.col("base"), F.col("_added")).alias("spans"))


def _all_spans(base: Column, added: Column) -> Column:
    empty = F.array().cast(f"array<{SPAN}>")

    def apart(done: Column, x: Column) -> Column:
        overlaps = F.exists(done, lambda y: (y["start"] < x["end"]) & (y["end"] > x["start"]))
        return F.when(overlaps, done).otherwise(F.concat(done, F.array(x)))

    keyed = F.transform(
        F.coalesce(added.cast(f"array<{SPAN}>"), empty),
        lambda x: F.struct(x["start"].alias("s"), (-x["end"]).alias("e"), x["kind"].alias("k")),
    )
    more = F.transform(
        F.array_sort(keyed), lambda x: F.struct(x["s"].alias("start"), (-x["e"]).alias("end"), x["k"].alias("kind"))
    )
    return F.when(F.size(more) == 0, base).otherwise(_in_order(F.aggregate(more, base, apart)))


def written(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    name = F.array(*map(F.lit, KINDS))
    each = F.transform(
        spans, lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))
    )
    return F.array_join(each, ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans per document row."""
    counts = [
        F.size(F.filter("base", _is_kind(number))).cast("bigint").alias(f"n_{kind}")
        for number, kind in enumerate(KINDS)
    ]
    return find(docs).select(
        "doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; overlapping spans become the first one's."""
    names = {c: fresh(docs, f"pii_{c}") for c in ("id", "hash", "added", "spans")}
    added = new_spans(facts(docs)).select(
        F.col("doc_id").alias(names["id"]), F.col("text_hash").alias(names["hash"]), F.col("added").alias(names["added"])
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = {names["id"]: F.col("doc_id"), names["hash"]: F.xxhash64(text)}
    joined = dimension_join(docs, stage(added, "added"), keys, "left")
    spans = _all_spans(base_spans(F.col("text")), F.col(names["added"]))
    joined = joined.withColumn(names["spans"], spans)
    s = F.col(names["spans"])

    def disjoint(done: Column, x: Column) -> Column:
        last = F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(0))
        return F.when(x["start"] >= last, F.concat(done, F.array(x))).otherwise(done)

    kept = F.aggregate(s, F.array().cast(f"array<{SPAN}>"), disjoint)
    label = F.array(*[F.lit(f"<{kind}>") for kind in KINDS])

    def cut(k: Column) -> Column:
        pieces = F.transform(
            k,
            lambda x, i: F.concat(
                F.substring(
                    text,
                    F.coalesce(F.get(k, i - 1)["end"], F.lit(0)) + 1,
                    x["start"] - F.coalesce(F.get(k, i - 1)["end"], F.lit(0)),
                ),
                F.get(label, x["kind"]),
            ),
        )
        end = F.element_at(k, -1)["end"]
        return F.concat(F.array_join(pieces, ""), F.substring(text, end + 1, F.length(text) - end))

    new = F.when(F.size(s) > 0, F.transform(F.array(kept), cut)[0]).otherwise(F.col("text"))
    return joined.withColumn("text", new).select(*docs.columns)
