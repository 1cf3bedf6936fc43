"""Each operator against a brute-force version on a small fixture that holds the odd cases."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sentencepiece import SentencePieceProcessor

from dosecast.llm import (
    bpe, chat, decontaminate, fill_in_middle, filter_audit, html_text, jaccard_join, packed_ids, pii, quality_model,
    quality_rules, sentence_pieces, token_counts,
)
from dosecast.llm.common import BYTE_BPE, PIECE_BPE, WORD_BPE, loaded

WORDS = ["alpha", "beta", "gamma", "delta", "Überfluß", "été", "12", "end."]


def text_of(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{seed if k % 3 == 0 else ''}{k % 7}" for k, i in enumerate(rng.integers(0, 8, n)))


LONG = text_of(1, 3000)
ODD = [
    None, "", "   \n ", "x", LONG, LONG, text_of(2, 120), text_of(2, 120) + " one more word", text_of(3, 60), "of " * 200,
    "\x1c a\x1db \x85 x​ <|endoftext|>Hello<|startoftext|>!! it's WE'LL", "ΑΣ Σ ΣΑΣ İstanbul ǅ ŉ ﬀ ẞ é 한글 😀👨‍👩‍👧",
    "a" * 3000, "1" * 3000, "1 " * 2000, "a." * 2000 + "@" + "b." * 2000, "line\nline\n\nline two\nline",
    "mail a_b@c.d.e, a@b.c@d.e ..x@y-z.w 1.2.3.4.5 1.2.3.256 01.002.3.4 4111 1111 1111 1111 -4111-1111-1111-1111",
    "call +1 (988) 555-2485 or +12 or +1234567890) or +1-234-567-8901.",
]
SCHEMA = "doc_id bigint, text string, words array<int>, quality_facts int, row_number int, _id string, n_tokens int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, 1, 2, "z", 3) for i, t in enumerate(ODD)]
    rows += [(6, ODD[6], None, 1, 2, "z", 3), (None, text_of(2, 120), None, 1, 2, "z", 3)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def test_token_counts(docs, nothing):
    library = Tokenizer.from_file(WORD_BPE)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    expected = Counter((i, len(t.encode()), count(t)) for i, t in texts(docs))
    assert rows_of(token_counts.token_counts(docs)) == expected
    assert rows_of(token_counts.token_counts(docs, block_chars=10)) == expected
    assert token_counts.token_counts(nothing).count() == 0


def test_chat(spark):
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi 😀"), (1, 2, "bob", None), (1, 3, "cy", "yo"), (1, 3, "cy", "yo"),
        (2, 0, "system", "alone"), (None, 0, "ann", "x"), (3, None, "ann", "x"), (3, 5, None, "x"),
        *[(4, k, "ann" if k % 2 else "bob", f"t{k}") for k in range(200)],
    ]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    out = chat.perspectives(df).orderBy("conv_id", "speaker", "part").collect()
    expected = []
    for conv in (1, 4):
        own = sorted((t[1], t[2], t[3] or "") for t in turns if t[0] == conv)
        for speaker in sorted({r for _, r, _ in own} - {"system"}):
            at, parts = 0, {}
            for turn, role, text in own:
                who = "system" if role == "system" else "assistant" if role == speaker else f"user name={role}"
                piece = f"<|im_start|>{who}\n{text}<|im_end|>\n"
                part = parts.setdefault(turn // 64, [0, at, "", []])
                part[0] += 1
                part[2] += piece
                at += len(piece)
                if role == speaker:
                    part[3].append(f"{at - len(text) - 11}:{at}")
            expected += [(conv, speaker, p, n, s, t, ",".join(m)) for p, (n, s, t, m) in parts.items()]
    assert [tuple(r) for r in out] == expected
    assert chat.perspectives(df.where("false")).count() == 0


def test_quality_model_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"  # the smallest table has under twenty held-out labels
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality_model.train(docs, labels)
    out = quality_model.scores(docs, model)
    marked = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in out.collect() if r.doc_id in marked]
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.predicted == marked[r.doc_id] for r in held) >= 0.9 * len(held)


def test_quality_model_odd_cases(docs, nothing, spark):
    labels = spark.createDataFrame([(4, 1), (9, 0), (6, None), (None, 1), (8, 1), (8, 0)], "doc_id bigint, quality int")
    out = quality_model.scores(docs, quality_model.train(docs, labels)).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    none = quality_model.train(docs, labels.where("false"))
    assert {r.score for r in quality_model.scores(docs, none).collect()} == {0.5}
    assert quality_model.scores(nothing, none).count() == 0


def base_rules(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    times, inside, seen, again = Counter(windows), set(), set(), 0
    for i, window in enumerate(windows):
        if times[window] > 1:
            inside |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    failed = len(own) < 50 or 100 * len(inside) > 50 * len(own)
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside), failed


def ngram_buckets(text):
    import xxhash

    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in own]
    pairs = [xxhash.xxh64_intdigest(b.encode(), a) for a, b in zip(hashes, own[1:])]
    return Counter(h % quality_rules.BUCKETS for h in hashes + pairs)


def verdicts(rows, trusted):
    """(facts, score, kept) of each (id, text), by the formula."""
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(ngram_buckets(t))
        if i in trusted:
            target.update(ngram_buckets(t))
    all_raw, all_target = raw.total(), target.total()

    def score(i, t):
        own, known = ngram_buckets(t), i in trusted
        n = own.total()
        share = (all_target - n * known) / max(all_raw - n, 1)
        parts = [c * np.log((target[b] - c * known + 1) / ((raw[b] - c) * share + 1)) for b, c in sorted(own.items())]
        return round(sum(parts) / n, quality_rules.DIGITS) if n else 0.0

    facts = [base_rules(t) for _, t in rows]
    scores = [None if f[-1] or not all_target else score(i, t) for f, (i, t) in zip(facts, rows)]
    passed = sorted(s for s, (i, _) in zip(scores, rows) if s is not None and i in trusted)
    least = min(quality_rules.MIN_SCORE, passed[int(np.ceil(quality_rules.QUANTILE * len(passed))) - 1] if passed else 0)
    kept = [not f[-1] and (not all_target or s >= least) for f, s in zip(facts, scores)]
    return list(zip(facts, scores, kept)), least


def test_quality_rules(docs, nothing, spark):
    trusted = spark.createDataFrame([(6,), (6,), (None,), (8,)], "doc_id bigint")
    out = quality_rules.rules(docs, trusted)
    expected, _ = verdicts(texts(docs), {6, 8})
    made = [(*[r[c] for c in BASE], r.held_out, r.kept) for r in out.collect()]
    in_order = sorted(made, key=lambda r: (r[:-2], r[-2] or 0))
    for mine, (facts, score, kept) in zip(in_order, sorted(expected, key=lambda e: (e[0], e[1] or 0))):
        assert mine[:-2] == facts and mine[-1] == kept
        assert mine[-2] == (None if score is None else pytest.approx(score, abs=2e-5))
    assert len(made) == len(expected)
    kept = quality_rules.keep_good(docs, trusted)
    assert kept.columns == docs.columns and kept.count() == sum(k for *_, k in expected)
    everything = quality_rules.rules(docs, trusted.where("false")).collect()
    assert all(r.kept != r.base_failed for r in everything)
    assert quality_rules.rules(nothing, trusted).count() == 0
    for df in (out, kept):
        assert "split(" not in df._jdf.queryExecution().optimizedPlan().toString()  # each text was cut once, before


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_verdict_by_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    rows = texts(docs)
    expected, least = verdicts(rows, good)
    for parts in (1, 7):
        out = quality_rules.rules(docs.repartition(parts), labels.where("quality = 1").select("doc_id")).collect()
        by_id = {r.doc_id: r for r in out}
        for (i, _), (facts, score, kept) in zip(rows, expected):
            row = by_id[i]
            assert tuple(row[c] for c in BASE) == facts
            assert row.held_out == (None if score is None else pytest.approx(score, abs=2e-5))
            assert row.kept == kept or abs(score - least) < 2e-5
    assert any(k for *_, k in expected) and not all(k for *_, k in expected)


def test_cut_is_exact_beyond_a_hundred_thousand_scores(spark):
    scores = spark.range(150_000).select(((F.col("id") * 7919) % 150_000 / 100_000 - 2).alias("score"))
    found = {quality_rules.cut(scores.select(F.round("score", 5).alias("score")).repartition(n), "score") for n in (1, 3, 16)}
    assert len(found) == 1 and found.pop() == pytest.approx(-2 + (150_000 * quality_rules.QUANTILE - 1) / 100_000, abs=1e-9)


@pytest.mark.parametrize("size, share", [("sf0.001", 1.0), ("sf0.01", 1.0), ("sf0.01", 0.3), ("sf0.001", 0.3)])
def test_quality_verdict_at_sizes_and_label_shares(spark, size, share):
    folder = f"/root/testdata/{size}"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    quality = {r.doc_id: r.quality for r in labels.collect()}
    chosen = [(i,) for i, q in sorted(quality.items()) if q == 1 and zlib.crc32(str(i).encode()) % 100 < 100 * share]
    kept = {r.doc_id: r.kept for r in quality_rules.rules(docs, spark.createDataFrame(chosen, "doc_id bigint")).collect()}
    clean, bad = {}, []
    for r in docs.collect():
        own = (r.text or "").split()
        odd = sum(bool(re.search(r"[#*$%&|<>]", w)) + ("!!" in w) for w in own)
        if base_rules(r.text or "")[-1]:
            continue
        if quality.get(r.doc_id) == 0:
            bad.append(kept[r.doc_id])
        elif 10 * odd <= len(own):
            clean.setdefault(r.lang, []).append(kept[r.doc_id])
    assert set(clean) == {"en", "de", "fr", "es"}
    for lang, verdicts in clean.items():
        assert sum(verdicts) >= 0.8 * len(verdicts), (lang, sum(verdicts), len(verdicts))
    every = [v for verdicts in clean.values() for v in verdicts]
    assert sum(every) >= 0.9 * len(every)
    assert sum(bad) <= 0.4 * len(bad)


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=40), st.data())
def test_packing_round_trip(bits, ids, data):
    ids = np.array([i % (1 << bits) for i in ids], dtype="<u4")
    packed = packed_ids.pack(ids, bits)
    assert len(packed) == (len(ids) * bits + 7) // 8 or bits == 16
    first = data.draw(st.integers(0, len(ids)))
    assert (packed_ids.unpack(packed, bits, first, len(ids) - first) == ids[first:]).all()


_ODD = st.sampled_from(["a", "b", " ", "\n", "  ", "\t", ".", ",", "'s", "é", "漢字", "\xa0", "1", "<|endoftext|>", "\x1c", "🙂"])


@settings(deadline=None)
@given(st.lists(st.lists(_ODD, max_size=12).map("".join), min_size=1, max_size=20))
def test_packed_ids_of_odd_white_space(texts):
    library = loaded(packed_ids._tokenizer, BYTE_BPE)
    made = loaded(packed_ids.Encoder, BYTE_BPE)(texts)
    assert [x.tolist() for x in made] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_packed_ids(docs, nothing, spark, tmp_path):
    library = Tokenizer.from_file(BYTE_BPE)
    ordered = sorted(texts(docs), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    expected, at, ids_of = Counter(), 0, {}
    for i, t in ordered:
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], dtype="<u4")
        expected[i, at, len(ids), zlib.crc32(ids.tobytes())] += 1
        at, ids_of[i] = at + len(ids), ids
    assert rows_of(packed_ids.round_trip(docs)) == expected
    path = str(tmp_path / "packed")
    assert packed_ids.write_packed(docs, path, block_ids=500) == 16
    assert rows_of(packed_ids.read_packed(spark, path, crc_only=True)) == expected
    assert (packed_ids.document_ids(spark.read.parquet(path), 11) == ids_of[11]).all()
    assert packed_ids.document_ids(spark.read.parquet(path), 999) is None
    assert packed_ids.round_trip(nothing).count() == 0


def test_decontamination(docs, nothing, spark):
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", LONG.lower())
    items = [(1, " ".join(own[50:64])), (2, "LINE two!"), (10, "LINE two!"), (3, None), (4, "..."), (None, "call"), (5, "not in any text")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: word.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    expected = Counter()
    for i, t in texts(docs):
        w, hit, found = low(t), set(), set()
        for item, text in items:
            g = low(text)
            for gram in [g[k : k + 10] for k in range(max(1, len(g) - 9))] if g else []:
                for at in range(len(w) - len(gram) + 1):
                    if w[at : at + len(gram)] == gram:
                        hit.update(range(at, at + len(gram)))
                        found |= {str(item)} if item is not None else set()
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        expected[i, len(w), len(hit), len(found), digest, bool(hit)] += 1
    assert rows_of(decontaminate.report(docs, bench)) == expected
    one, parts = decontaminate.hits(docs, bench), decontaminate.hits(docs, bench, broadcast_bytes=200)
    in_order = lambda df: sorted(map(str, df.collect()))
    assert in_order(one) == in_order(parts)
    clean = decontaminate.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    bad = sum(n for r, n in expected.items() if r[-1])
    assert clean.count() == docs.count() - bad
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench, "spans").collect()}
    assert cut[16] == "line\nline\n\n \nline" and cut[0] is None and len(cut) == len({i for i, _ in texts(docs)})
    assert decontaminate.report(nothing, bench).count() == 0
    assert decontaminate.report(docs, bench.where("false")).where("contaminated").count() == 0


@pytest.mark.parametrize("remove", ["documents", "spans"])
def test_decontaminate_does_not_depend_on_the_benchmark_size(spark, remove):
    leak = "one two three four five six seven eight nine ten eleven"
    rows = [(None, f"So {leak}, indeed"), (None, "clean text"), (7, leak), (7, "another clean text"), (8, None), (None, None), (9, "Short, item")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS row", "2 AS row_number", "'x' AS hit_spans")
    bench = spark.createDataFrame([(1, leak), (2, "short item"), (None, leak), (2, "short item")], "item_id bigint, text string")
    one = decontaminate.decontaminate(docs, bench, remove)
    far = decontaminate.decontaminate(docs, bench, remove, broadcast_bytes=100)
    assert far.columns == docs.columns and rows_of(far) == rows_of(one)
    assert far.count() == (4 if remove == "documents" else 7)
    in_order = lambda df: sorted(map(str, df.collect()))
    assert in_order(decontaminate.hits(docs, bench)) == in_order(decontaminate.hits(docs, bench, broadcast_bytes=100))


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_data(text):
    out = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in re.sub("[^0-9]", "", m[0])]
            luhn = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))) % 10 == 0
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and luhn, "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), number, m.end(), kind))
    return sorted(out)


def test_personal_data(docs, nothing, spark):
    calls = [(100 + k, f"please call me on +1 (988) 555-24{k} now") for k in range(10, 16)]
    calls += [(200, "please call me on 988-555-2499 now"), (201, "it cost 988-555-2499 there")]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(calls, "doc_id bigint, text string"))
    out = pii.report(more).collect()
    by_digest = {}
    for _, t in texts(more):
        found = base_data(t)
        written = ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)
        counts = Counter(k for *_, k in found)
        by_digest[hashlib.sha256(written.encode()).hexdigest()] = written, *(counts[k] for k in PATTERNS)
    assert len(out) == more.count()
    for r in out:
        written, *counts = by_digest[r.base_sha256]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        assert r.spans == ({200: "phone:18:30", 201: "phone:8:20"}.get(r.doc_id) or written)
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[18] == "call <phone> or +12 or <phone>) or <phone>." and clean[0] is None and clean[4] == LONG
    assert pii.redact(docs).columns == docs.columns
    assert pii.report(nothing).count() == 0


def test_personal_data_spaced_bracketed_and_labelled(spark):
    said = {f"please call me on +1 (988) 555-24{k} now": None for k in range(10, 20)}
    said |= {f"{w} {w}s {w}ly Tel: +1 (988) 555-25{k} {w}er": None for k, w in enumerate("ab cd ef gh ij kl mn op qr st".split(), 10)}
    said |= {f"it is on card number {n} until May": None for n in ("4111 1111 1111 1111", "5500 0000 0000 0004", "3400 0000 0000 009", "6011 0000 0000 0004")}
    looked_for = [
        ("please call me on {} now", "(988) 555-2499", "phone"), ("please call me on {} now", "988 555 2498", "phone"),
        ("please call me on {} now", "0044 20 7946 0958", "phone"), ("please call me on {}.", "988-555-2497", "phone"),
        ("please call me on ({})", "988-555-2496", "phone"), ("some other words Tel: {} here", "988 555 2495", "phone"),
        ("at last Tel:{}.", "988-555-2494", "phone"), ("it is on card number {} until May", "4111 1111 1111 1112", "card"),
    ]
    for sentence, value, kind in looked_for:
        at = sentence.index("{}")
        said[sentence.format(value)] = f"{kind}:{at}:{at + len(value)}"
    said["there were 988 555 2498 99 1 of them"] = ""
    df = spark.createDataFrame(list(enumerate(said)), "doc_id bigint, text string")
    out = {r.doc_id: r.spans for r in pii.report(df).collect()}
    for i, (text, spans) in enumerate(said.items()):
        assert spans is None or out[i] == spans, text


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", text.lower().encode())
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def check_join(df):
    sets = {}
    for i, t in texts(df):
        if i is not None:
            sets[i] = shingles(t)
    reps = {}
    for i in sorted(sets):
        if sets[i]:
            reps.setdefault(sets[i], i)
    ids, parent, links = sorted(reps.values()), {}, Counter()

    def top(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links.update((a, b))
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    for r in jaccard_join.similar_texts(df).collect():
        if r.doc_id is None:
            assert r.class_id is None and r.n_links == 0
            continue
        rep = reps.get(sets[r.doc_id], r.doc_id)
        assert (r.copy_of, r.class_id, r.n_links) == (rep, top(rep), links[rep])


def test_jaccard_join(docs, nothing):
    check_join(docs)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in texts(docs)} - {5, 7}
    assert jaccard_join.similar_texts(nothing).count() == 0


def test_jaccard_join_tells_texts_of_one_id_apart(spark):
    """Every row by brute force on (id, text), with repeated ids, repeated rows, nulls and texts that differ in case alone."""
    def base(seed):
        return " ".join(f"w{seed}x{i}" for i in range(60))

    a, b, c = base(1), base(2), base(3)
    rows = [(5, a), (5, b), (1, a + " more"), (6, b + " more"), (5, c), (5, c), (7, c.upper()), (5, c.upper()), (None, a),
            (5, None), (5, ""), (9, base(4)), (2, b + " less")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    expect = {
        (5, a): (1, 5, 1), (1, a + " more"): (1, 1, 1), (5, b): (2, 5, 2), (6, b + " more"): (2, 6, 2),
        (2, b + " less"): (2, 2, 2), (5, c): (5, 5, 0), (7, c.upper()): (5, 5, 0), (5, c.upper()): (5, 5, 0),
        (None, a): (None, None, 0), (5, None): (5, 5, 0), (5, ""): (5, 5, 0), (9, base(4)): (9, 9, 0),
    }
    got = Counter((r.doc_id, r.class_id, r.copy_of, r.n_links) for r in jaccard_join.similar_texts(df).collect())
    assert got == Counter((i, *expect[i, t]) for i, t in rows)
    kept = Counter(tuple(r) for r in jaccard_join.keep_one(df).collect())
    least = min(c.upper(), c, key=lambda t: hashlib.md5(f"5:{hashlib.md5(t.encode()).hexdigest()}".encode()).digest())
    assert kept == Counter([
        (1, a + " more"), (2, b + " less"), *[r for r in rows if r == (5, least)], (None, a), (5, None), (5, ""), (9, base(4))
    ])


def test_jaccard_join_splits_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 8)
    base = text_of(9, 200).split()
    rows = []
    for i in range(60):
        own = list(base)
        own[i] = own[i + 100] = f"changed{i}"
        rows.append((i, " ".join(own)))
    rows += [(100 + i, "the very same first line of nine words here " + text_of(1000 + i, 15)) for i in range(60)]
    check_join(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_bpe(docs, nothing):
    library = Tokenizer.from_file(WORD_BPE)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = Counter()
    for i, t in texts(docs):
        ids = library.encode(t, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[i, len(ids), digest(" ".join(map(str, ids))), digest(decoded)] += 1
    assert rows_of(bpe.digests(docs)) == expected
    decoded = bpe.decode(bpe.encode(docs))
    assert Counter((r.doc_id, digest(r.text)) for r in decoded.collect()) == Counter((e[0], e[3]) for e in expected.elements())
    assert bpe.digests(nothing).count() == 0


def test_some_words_fail_the_speculation():
    tried = bpe.loaded(bpe.Speculator, WORD_BPE)
    parts = ("th", "er", "on", "an", "tion", "wh", "ed", "ble", "aa", "é")
    words = [tried.text.symbols("".join(p)) for p in itertools.product(parts, repeat=3)]
    assert tried.encode_words(words) == [tried.merged(tried.symbols(w)) for w in words]
    assert any(tried.proposed(w) != tried.merged(tried.symbols(w)) for w in words)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav><header>Site name</header><div class="cookie-notice">We use</div>
<div id="content"><h1>Head &amp; line</h1><p>First <b>bold paragraph with many words in it, and more of them.<br><p>Second
 paragraph,  folded &eacute; &#8364; white space and quite some text to read.</div>
<div class="comments"><p>Nice!</p></div><aside>Side</aside><form><p>Your name</p></form><footer>&copy; me</footer></body>"""


def test_html(spark):
    article = "Head & line\nFirst bold paragraph with many words in it, and more of them.\nSecond paragraph, folded é € white space and quite some text to read."
    pages = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "<p>a<p>b"), (1, "u", PAGE), (4, "u", "<nav>menu</nav>"),
             (5, "u", "<div>" * 5000 + "deep"), (6, "u", "<article><p>x</article><p>" + "y " * 9), (7, "u", "a < b & c <"), (8, "u", "<p title='>'>q")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").selectExpr("*", "'k' AS text", "1 AS n_chars")
    out = {(r.page_id, r.url): r.text for r in html_text.main_texts(df).collect()}
    assert out[1, "u"] == article
    assert out[2, None] == out[3, "u"] == out[4, "u"] == ""
    assert out[None, "u"] == "a\nb" and out[5, "u"] == "deep" and out[7, "u"].startswith("a < b") and out[8, "u"] == "q"
    assert html_text.main_texts(df).count() == len(pages)
    assert html_text.main_texts(df.where("false")).count() == 0


def paragraphs(label, n=5):
    return [f"{label}{k} " + "plain words of the text " * 13 + "end." for k in range(n)]


@pytest.mark.parametrize("n_sections, n", [(2, 5), (3, 5), (2, 10)])
@pytest.mark.parametrize("wrap", ["{}", "<div id='page'>{}</div>"])
def test_html_sections_without_article(n_sections, n, wrap):
    own = [paragraphs("abc"[k], n) for k in range(n_sections)]
    inside = "".join("<div>" + "".join(f"<p>{p}</p>" for p in one) + "</div>" for one in own)
    links = "<div>" + "".join(f"<a href='/{k}'>link {k}</a>" for k in range(9)) + "</div>"
    page = f"<html><body>{links}{wrap.format(inside)}{links}</body></html>"
    assert html_text.extract(page) == "\n".join(p for one in own for p in one)


@pytest.mark.parametrize("before, after", [
    ("<main class='content with-sidebar'>", "</main>"), ("<div class='has-sidebar'>", "</div>"),
    ("<div class='layout-sidebar-right'>", "</div>"), ("<div id='search-results'>", "</div>"),
    ("<article class='discussion'>", "</article>"), ("<div class='page no_sidebar'><article>", "</article></div>"),
    ("<div class='modal'><main>", "</main></div>"),
])
def test_html_class_words_of_the_article(before, after):
    own = paragraphs("a")
    ad = "<div class='ad'><p>Buy this now, it is very good.</p></div><div class='sidebar'><p>Some other words here.</p></div>"
    page = f"<body>{ad}{before}{''.join(f'<p>{p}</p>' for p in own)}{after}{ad}</body>"
    assert html_text.extract(page) == "\n".join(own)


def test_html_headers_and_comments_of_an_article():
    own = paragraphs("a", 2)
    inside = "<header class='entry-header'><h1>Title</h1></header>" + "".join(f"<p>{p}</p>" for p in own)
    comments = "<section class='comments'>" + "".join(f"<article class='comment'><p>{p}</p></article>" for p in paragraphs("c", 9)) + "</section>"
    assert html_text.extract(f"<body><article>{inside}</article>{comments}</body>") == "\n".join(["Title", *own])


LINKS = "<ul>" + "".join(f"<li><a href='/{k}'>Other story number {k}</a></li>" for k in range(5)) + "</ul>"
BOX = "<div><p>Support our work. <a href='/give'>Donate now</a></p></div>"
CARDS = "<section><h3>More</h3><div><a href='/x'>A teaser of another story</a></div></section>"


@pytest.mark.parametrize("tag", ["article", "main", "div"])
@pytest.mark.parametrize("extra", [LINKS, BOX, CARDS, f"<div>{LINKS}</div>", LINKS + BOX + CARDS])
def test_html_links_inside_the_article_go(tag, extra):
    own = paragraphs("a")
    nav = "<div>" + "".join(f"<a href='/{k}'>link {k}</a>" for k in range(9)) + "</div>"
    for cut in (1, 3, 5):
        inside = "".join(f"<p>{p}</p>" for p in own[:cut]) + extra + "".join(f"<p>{p}</p>" for p in own[cut:])
        assert html_text.extract(f"<body>{nav}<{tag}>{inside}</{tag}></body>") == "\n".join(own)


@pytest.mark.parametrize("tag", ["article", "div"])
def test_html_short_parts_of_the_article_stay(tag):
    own = paragraphs("a")
    inside = (
        "<h1>Title</h1><div><h2>Part</h2></div>" + "".join(f"<p>{p}</p>" for p in own)
        + "<ul><li>one</li><li>two, see <a href='/s'>here</a></li></ul><p><a href='/t'>A line of its own</a></p><div>End.</div>"
    )
    want = ["Title", "Part", *own, "one", "two, see here", "A line of its own", "End."]
    assert html_text.extract(f"<body><nav>menu</nav><{tag}>{inside}</{tag}></body>") == "\n".join(want)


def plain_density(e, root):
    """Density by the formula, counted anew for each element."""
    def count(x, in_link):
        chars = tags = link_chars = link_tags = 0
        for c in x.children:
            if isinstance(c, str):
                n = len(re.sub(r"\s", "", c))
                chars, link_chars = chars + n, link_chars + n * in_link
            elif not c.drop:
                a, b, d, f = count(c, in_link or c.tag == "a")
                chars, tags, link_chars, link_tags = chars + a, tags + b + 1, link_chars + d, link_tags + f + (c.tag == "a")
        return chars, tags, link_chars, link_tags

    in_link, up = False, e
    while up is not None:
        in_link, up = in_link or up.tag == "a", up.parent
    chars, tags, link_chars, link_tags = count(e, in_link)
    page_chars, _, page_links, _ = count(root, False)
    if chars == 0:
        return 0.0
    base = math.log(chars / max(1, chars - link_chars) * link_chars + page_links / max(1, page_chars) * chars + math.e)
    tags, link_chars, link_tags = max(1, tags), max(1, link_chars), max(1, link_tags)
    return max(0.0, chars / tags * math.log(max(1.0, chars * tags / (link_chars * link_tags))) / base)


def test_html_densities_and_scores_by_brute_force(spark, sf):
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").select("html").collect()]
    for html in [*pages[:30], PAGE, f"<body>{LINKS}<article><p>{'x ' * 99}{LINKS}{BOX}</article>{CARDS}"]:
        root = html_text.parse(html)
        html_text.measure(root)
        best, stack = None, [root]
        while stack:
            e = stack.pop()
            kids = [c for c in e.children if not isinstance(c, str) and not c.drop]
            stack.extend(kids)
            assert e.density == pytest.approx(plain_density(e, root))
            own = sum(len(re.sub(r"\s", "", c)) for c in e.children if isinstance(c, str))
            assert e.score == pytest.approx(own + sum(plain_density(c, root) for c in kids))
            best = max(best or e.score, e.score)
        assert best == max(e.score for e in html_text.main_elements(root)) or root.chars == 0 or any(
            x.score == best for e in html_text.main_elements(root) for x in subtree(e)
        )


def subtree(e):
    yield e
    for c in e.children:
        if not isinstance(c, str) and not c.drop:
            yield from subtree(c)


def test_html_density_finds_the_article_without_its_tag(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("html").collect()]
    untagged = [html_text.extract(re.sub(r"<(/?)(article|main)\b", r"<\1div", h)) for h in pages]
    tagged = [html_text.extract(h) for h in pages]
    # the tag decides only where an advert outdoes the article; the advert is then taken too, and nothing is lost
    assert sum(map(str.__eq__, tagged, untagged)) >= 0.99 * len(pages)
    assert all(t in u for t, u in zip(tagged, untagged, strict=True))


def test_html_finds_every_article(spark, sf):
    from html import unescape

    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inside)]
        assert html_text.extract(r.html) == "\n".join(p for p in parts if p)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def in_the_middle(doc_id, text):
    digest = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle(docs, nothing, spark):
    more = ["a <P> b", "<S", "<M>", "<" * 40, "<P" * 9 + ">", "😀é\n\r\n\u2028" * 3000, "x" * 4096, "y" * 4097, "$1 \\1 ${2}", "\n"]
    extra = spark.createDataFrame([(i, t) for i in range(100, 130) for t in more], "doc_id bigint, text string")
    both = docs.select("doc_id", "text").union(extra)
    expected = Counter(in_the_middle(i, t) for i, t in texts(both))
    made = fill_in_middle.fill_in_middle(both)
    assert rows_of(made) == expected
    assert {f for _, _, f, *_ in expected} == {"plain", "psm", "spm"}
    digested = Counter((*row[:5], sha(row[5])) for row in expected.elements())
    out = fill_in_middle.digests(both)
    assert rows_of(out.drop("restored_sha256")) == digested
    assert Counter(r.restored_sha256 for r in out.collect()) == Counter(sha(t) for _, t in texts(both))
    assert fill_in_middle.digests(nothing).count() == 0
    plan = fill_in_middle.digests(extra)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


MARKED = ["  two  blanks ", " ", "   ", "▁ literal ▁▁x", "tab\t\tnew\nline", "a\x00b", "<s> </s> <unk> <0x0A>", "漢字 かな 🙂 \ue000", "x" * 20_000, "end "]


def test_sentence_pieces(docs, nothing, spark):
    library = SentencePieceProcessor(model_file=PIECE_BPE)
    extra = spark.createDataFrame([(200 + i, t) for i, t in enumerate(MARKED)], "doc_id bigint, text string")
    both = docs.select("doc_id", "text").union(extra).repartition(3)
    ids = {t: tuple(library.encode(t)) for _, t in texts(both)}
    expected = Counter((i, ids[t]) for i, t in texts(both))
    for sizes in ({}, {"block_chars": 10, "shards": 3}):
        assert Counter((r.doc_id, tuple(r.ids)) for r in sentence_pieces.encode(both, **sizes).collect()) == expected
    digested = Counter(
        (i, len(x), sha(",".join(map(str, x))), sha(library.decode(list(x)))) for i, x in expected.elements()
    )
    assert rows_of(sentence_pieces.digests(both)) == digested
    back = Counter((i, library.decode(list(x))) for i, x in expected.elements())
    assert rows_of(sentence_pieces.decode(sentence_pieces.encode(both))) == back
    assert sentence_pieces.digests(nothing).count() == 0


def test_sentence_pieces_segment_each_chunk_once(monkeypatch):
    import pyarrow as pa

    given_to_library = []
    pieces = loaded(sentence_pieces.Pieces, PIECE_BPE)
    real = pieces.segmented
    monkeypatch.setattr(pieces, "segmented", lambda chunks: given_to_library.extend(chunks) or real(chunks))
    rows = [(b, s, sentence_pieces.pack_chunks([f"▁w{s}", "▁▁x" * (b + 1)])) for s in (1, 2) for b in range(3)]
    batch = pa.record_batch({n: pa.array(c) for n, c in zip(("block", "shard", "chunks"), zip(*rows))})
    out = pa.Table.from_batches(sentence_pieces.segmented_packs(iter([batch.slice(0, 2), batch.slice(2)]), PIECE_BPE))
    assert Counter(given_to_library) == Counter({"▁w1": 1, "▁w2": 1, **{"▁▁x" * (b + 1): 2 for b in range(3)}})
    assert out.num_rows == 6


@settings(deadline=None)
@given(st.lists(st.sampled_from(["a", "the", " ", "▁", "  ", "\n", "é", "漢", "🙂", ".", "<s>", "\x00", "1"]), max_size=15).map("".join))
def test_chunks_of_odd_white_space(text):
    pieces = loaded(sentence_pieces.Pieces, PIECE_BPE)
    ids = [i for found in pieces.segmented(pieces.chunks(text)) for i in found]
    assert ids == pieces.library.encode(text)


def audited(rows, labels):
    letters = "ABCDE"
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    smallest = {}
    for i, text, _ in rows:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    out = {}
    for i, text, source in rows:
        text = text or ""
        own = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            letter
            for letter, fails in zip(
                letters,
                (
                    len(own) < 50,
                    100 * len(set(own)) < 65 * len(own),
                    100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                    re.search(r"[#$%&*|]", text),
                    i is not None and smallest[text] < i,
                ),
                strict=True,
            )
            if fails
        }
        for order in map("".join, itertools.permutations(letters)):
            gone = False
            for step, letter in enumerate(order, 1):
                counts = out.setdefault((source or "", order, step), [0] * 6)
                fails = letter in failed
                removed, redundant = fails and not gone, fails and gone
                gone = gone or fails
                added = (not gone, removed, redundant, failed == {letter}, removed and i in good, removed and i in toxic)
                counts[:] = [a + b for a, b in zip(counts, added)]
    share = Counter()
    for (part, order, step), counts in out.items():
        share[part, order[step - 1]] += counts[1]
    return {(p, o, s, *c, share[p, o[s - 1]]) for (p, o, s), c in out.items()}


def test_filter_audit(nothing, spark):
    rows = [(i, t, "hot" if i % 3 else None) for i, t in enumerate(ODD)]
    rows += [(6, ODD[6], "hot"), (None, ODD[6], "x"), (None, "", ""), (50, ODD[6], "x"), (-1, text_of(3, 60), "x"), (51, "A# " * 60, "y")]
    rows += [(100 + i, "same " * 60, "hot") for i in range(40)]
    labels = [(4, 1, 0), (6, 1, 1), (6, 0, 0), (None, 1, 1), (9, 0, 1), (50, None, 1), (102, 1, None), (8, 1, 0)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id bigint, text string, source string, part int, digest string").repartition(4)
    marks = spark.createDataFrame([(*r, 5) for r in labels], "doc_id bigint, quality int, toxic int, n int")
    out = filter_audit.filter_audit(df, marks).collect()
    assert {tuple(r) for r in out} == audited(rows, labels) and len(out) == 600 * 4
    empty = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert filter_audit.filter_audit(empty, marks).count() == 0
    unmarked = filter_audit.filter_audit(df, marks.where("false")).agg({"good_lost": "sum", "toxic_lost": "sum"}).first()
    assert tuple(unmarked) == (0, 0)


def test_packed_counters_hold_large_numbers():
    many = (1 << 55) - 1
    table = filter_audit.part_rows("p", [0, 1, 31, 31 | filter_audit.GOOD], [many, many, many, many])
    first = table.slice(0, 1).to_pylist()[0]
    assert first["filter_order"] == "ABCDE" and first["kept"] == many and first["removed"] == 3 * many
    assert first["good_lost"] == many and first["unique_fails"] == many


def test_long_words_merge_in_time():
    import time

    speculator = loaded(bpe.Speculator, WORD_BPE)
    rng = np.random.default_rng(5)
    for n in (bpe.HEAP_FROM, 1000, 3000):
        word = "".join(rng.choice(list("abcdeinorst"), n))
        ids = speculator.symbols(word)
        by_heap = speculator.merged_by_heap(ids)
        assert by_heap == Tokenizer.from_file(WORD_BPE).encode(word, add_special_tokens=False).ids
    started = time.monotonic()
    word = "".join(rng.choice(list("abcdeinorst"), 200_000))
    assert speculator.merged(speculator.symbols(word)) == Tokenizer.from_file(WORD_BPE).encode(word, add_special_tokens=False).ids
    assert time.monotonic() - started < 60


def plain_context(text, start, end):
    """The lexical patterns of a span, from all of the text."""
    left = re.sub(r"\($", "", text[:start]).lower()
    blank = left[-1:] in tuple(" \t\n")
    words = left.split()
    after = text[end:].lower()
    right = after.split()[:1] if after[:1] in tuple(" \t\n") else []
    label = re.search(r"[^\s:=#]+[:=#]\s*\Z", " ".join(words[-1:]) + (" " if blank else ""))
    return [
        f"{words[-2]} {words[-1]} _" if blank and len(words) > 1 else None,
        f"{words[-1]} _ {right[0]}" if blank and words and right else None,
        f"{label[0].strip()} _" if label else None,
    ]


def test_pii_contexts_are_whole_words_of_any_length(spark):
    long, mail = "w" * 5000, "a@b.cd"
    texts = [
        f"{long} {mail} {long}", f"x {long} {mail}", f"{long} {long} {mail} {long} y", f"one two {mail} three four", f"{long}: {mail}",
        f"k{'v' * 90}= {mail} z", f"a {' ' * 300}b {' ' * 300}{mail}{' ' * 300}c", f"mail it ({mail}) now", f"{'q' * 79} at {mail}", mail,
        f"p {'q' * 74} at ({mail}", f"{'u ' * 60}{mail} {'é' * 80} é", f"{'u ' * 60}{mail} {'é' * 79} é",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: [m for m in r.mentions if m.known] for r in pii.facts(docs).select("doc_id", "mentions").collect()}
    for i, text in enumerate(texts):
        (mention,) = found[i]
        assert mention.instance == mail
        assert mention.patterns == plain_context(text, mention.start, mention.end), i
    huge = spark.createDataFrame([(1, f"{'L' * 200000} {mail} {'R' * 200000}")], "doc_id bigint, text string")
    (mention,) = pii.facts(huge).select("mentions").first().mentions
    assert [p and len(p) for p in mention.patterns] == [None, 400003, None]
