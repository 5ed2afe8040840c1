"""Operators on texts against brute force, and their defined odd cases."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
from brute import best_overlap
from pyspark.sql import functions as F

from courtside.llm import bpe, decontaminate, langid, license_scan, line_dedup, minhash, quality, suffix_dedup
from courtside.llm.common import ascii_lower
from courtside.llm.suffixes import Suffixes
from courtside.llm.tokens import shingles, word_hashes, words_of_batch

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def grouped(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


# --- suffix dedup ---


def removed(docs, length):
    seen, out = set(), {}
    for i, b in sorted(docs.items()):
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        out[i] = gone
    return out


def test_suffix_dedup_equals_brute_force(prose):
    docs = {r.doc_id: r.text.encode() for r in prose.collect()}
    for length in (100, 40):
        want = removed(docs, length)
        got = {r.doc_id: r for r in suffix_dedup.dedup_substrings(prose, length=length).collect()}
        assert len(got) == len(docs) and any(map(any, want.values()))
        for i, b in docs.items():
            assert got[i].kept == bytes(c for c, g in zip(b, want[i]) if not g)
            assert got[i].n_bytes == len(b) and got[i].n_removed == sum(want[i])
            assert sum(e - s for s, e in got[i].spans) == sum(want[i]) and all(x[1] < y[0] for x, y in zip(got[i].spans, got[i].spans[1:]))


def test_suffix_dedup_hot_kmers_take_the_other_way(prose, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 1)
    monkeypatch.setattr(suffix_dedup, "HOT_LEAST", 2)
    monkeypatch.setattr(suffix_dedup, "HOT_SHARE", 0.0)
    docs = {r.doc_id: r.text.encode() for r in prose.collect()}
    assert len(suffix_dedup.hot_kmers(prose.select(F.col("doc_id").alias("id"), "text"), 1, 100, 16))
    want = removed(docs, 100)
    assert {r.doc_id: r.n_removed for r in suffix_dedup.dedup_substrings(prose).collect()} == {i: sum(g) for i, g in want.items()}


def test_contexts_are_compared_on_bytes(prose):
    """Where all k-mer hashes collide, both comparisons still tell contexts apart."""
    texts = [r.text.encode() for r in prose.orderBy("doc_id").limit(60).collect()]
    kh, ch, doc, a, lo, hi = suffix_dedup.records(texts, 100, 16, np.empty(0, np.uint64))
    order = np.lexsort((a, doc))
    doc, a, lo, hi = (x[order].astype(np.int64) for x in (doc, a, lo, hi))
    contexts = [texts[d][x - y : x - z + 100] for d, x, y, z in zip(doc, a, lo, hi)]
    i, j = np.meshgrid(np.arange(40), np.arange(len(contexts)))
    i, j = i.ravel(), j.ravel()
    same = suffix_dedup.same_context(texts, doc, a - lo, a - hi + 100, i, j)
    assert same.tolist() == [contexts[x] == contexts[y] for x, y in zip(i, j)] and 40 <= same.sum() < len(same)
    hit, offset = suffix_dedup.equal_windows(np.zeros(len(a), np.uint64), lo, hi, np.frombuffer(b"".join(contexts), np.uint8), 100)
    seen, want = set(), set()
    for c in range(len(a)):
        own = {o: texts[doc[c]][a[c] - o : a[c] - o + 100] for o in range(hi[c], lo[c] + 1)}
        want |= {(c, o) for o, w in own.items() if w in seen}
        seen |= set(own.values())
    assert set(zip(hit.tolist(), offset.tolist())) == want and want


def test_suffix_dedup_in_passes(prose, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MAX_PARTS", 2)
    docs = {r.doc_id: r.text.encode() for r in prose.collect()}
    want = removed(docs, 100)
    assert {r.doc_id: r.n_removed for r in suffix_dedup.dedup_substrings(prose).collect()} == {i: sum(g) for i, g in want.items()}


def test_suffix_dedup_cuts_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUFFER", 1000)
    r = random.Random(3)
    a = "".join(r.choice("abc def") for _ in range(5000))
    docs = {1: a.encode(), 2: (a[2500:4200] + a[:900] + "x").encode()}
    got = suffix_dedup.dedup_substrings(spark.createDataFrame([(i, b.decode()) for i, b in docs.items()], "doc_id long, text string"))
    assert {x.doc_id: x.n_removed for x in got.collect()} == {i: sum(g) for i, g in removed(docs, 100).items()}


def test_suffix_dedup_odd_cases(odd_docs, no_docs):
    got = suffix_dedup.dedup_substrings(odd_docs).collect()
    assert len(got) == odd_docs.count() and suffix_dedup.dedup_substrings(no_docs).count() == 0
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.n_bytes for r in by[3] + by[4]] == [0, 0] and by[7][0].n_removed == by[7][0].n_bytes
    assert by[1][0] == by[1][1] and by[1][0].n_removed == 0 and len(by[None]) == 2


def test_suffix_sort_orders_and_measures():
    r = np.random.default_rng(1)
    for _ in range(20):
        buf = r.integers(97, 99, 400).astype(np.uint8)
        start = r.integers(0, 380, 60)
        end = np.minimum(start + r.integers(1, 60, 60), 400)
        group = np.sort(r.integers(0, 6, 60))
        s = Suffixes(buf, start, end)
        order = s.sort(group)
        key = [(g, bytes(buf[a:b])) for g, a, b in zip(group, start, end)]
        assert [key[i] for i in order] == sorted(key)
        common = s.extensions(order, group)
        for k in range(1, 60):
            x, y = key[order[k - 1]], key[order[k]]
            n = 0
            while n < min(len(x[1]), len(y[1])) and x[1][n] == y[1][n]:
                n += 1
            assert common[k] == (n if x[0] == y[0] else -1)


# --- lines ---


def test_ascii_lower_leaves_other_characters(spark):
    points = [c for c in range(1, 0x1FFFF) if not 0xD800 <= c < 0xE000]
    texts = [f"Ab{chr(c)}Z" for c in points] + [None, ""]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", ascii_lower(F.col("t")).alias("x")).collect()
    assert len(got) == len(texts) and all(r.x == (None if r.t is None else lower(r.t)) for r in got)


def test_line_dedup_hot_keys_take_the_other_way(prose, monkeypatch):
    table = prose.withColumn("text", F.concat(F.lit("one line in all of them\n"), "text", F.lit("\nsome lines are here")))
    want = {(r.doc_id, r.kept_text, r.n_dropped) for r in line_dedup.dedup_lines(table).collect()}
    for hot in (1, 10**9):  # no key is hot, and all are
        monkeypatch.setattr(line_dedup, "HOT", hot)
        assert {(r.doc_id, r.kept_text, r.n_dropped) for r in line_dedup.dedup_lines(table).collect()} == want


def test_line_dedup(prose, odd_docs, no_docs):
    for table in (odd_docs, prose):
        rows = table.collect()
        holders = {}
        key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
        big = 1 << 62
        for r in rows:
            for x in (r.text or "").split("\n"):
                if len(key(x)) >= 10:
                    holders.setdefault(key(x), set()).add(big if r.doc_id is None else r.doc_id)
        want = []
        for r in rows:
            lines = (r.text or "").split("\n")
            own = big if r.doc_id is None else r.doc_id
            kept = [x for x in lines if not (len(holders.get(key(x), ())) >= 2 and min(holders[key(x)]) != own)]
            want.append((r.doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
        got = [(r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(table).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want))
    assert line_dedup.dedup_lines(no_docs).count() == 0
    three = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(odd_docs.where("doc_id in (1, 2, 9, 10)"), min_docs=3).collect()}
    assert sum(three.values()) == 0
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(odd_docs.withColumn("n_lines", F.lit(1)), carry=("n_lines",))


# --- near duplicates ---


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates_equal_brute_force(prose, words):
    rows = sorted(prose.collect(), key=lambda r: r.doc_id)
    sets = []
    for r in rows:
        w = WORD.findall(lower(r.text))
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    want = grouped(len(sets), links)
    got = {r.doc_id: r for r in minhash.near_duplicates(prose, words=words).collect()}
    assert [got[i].component_id for i in range(len(sets))] == want and len(links) > 20
    assert [got[i].n_shingles for i in range(len(sets))] == [len(s) for s in sets]
    assert all(got[i].kept == (want[i] == i) for i in range(len(sets)))


def test_large_buckets_are_dealt_out_by_prefix(prose, monkeypatch):
    want = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(prose, words=4).collect()}
    star, calls = minhash.verified, []

    def none_at_first(pairs, *rest):  # without the star's links all groups are left to the search across them
        calls.append(1)
        return star(pairs, *rest).limit(0) if len(calls) == 1 else star(pairs, *rest)

    monkeypatch.setattr(minhash, "verified", none_at_first)
    assert {(r.doc_id, r.component_id) for r in minhash.near_duplicates(prose, words=4).collect()} == want and len(calls) == 1
    calls.clear()
    monkeypatch.setattr(minhash, "SPLIT", 1)
    assert {(r.doc_id, r.component_id) for r in minhash.near_duplicates(prose, words=4).collect()} == want and len(calls) == 2


def test_near_duplicates_odd_cases(odd_docs, no_docs):
    got = {}
    for r in minhash.near_duplicates(odd_docs, words=4).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[1]) == 2 and got[2][0].component_id == 1 and not got[2][0].kept and got[7][0].component_id == 6
    assert got[3][0].n_shingles == 0 and got[3][0].kept and got[5][0].kept and {r.component_id for r in got[None]} == {1, None} | {1} or got[None]
    assert minhash.near_duplicates(no_docs).count() == 0


def test_super_minhash_estimates():
    r = np.random.default_rng(2)
    a = np.unique(r.integers(0, 1 << 63, 600, dtype=np.uint64))
    for j in (0.5, 0.8, 0.95):
        keep = int(len(a) * 2 * j / (1 + j))
        b = np.unique(np.concatenate((a[:keep], r.integers(0, 1 << 63, len(a) - keep, dtype=np.uint64))))
        sig = minhash.super_minhash([a, b], 250)
        assert abs((sig[0] == sig[1]).mean() - j) < 0.12
    tiny = minhash.super_minhash([a[:1], a[:1], np.empty(0, np.uint64)], 150)
    assert (tiny[0] == tiny[1]).all() and len(set((tiny[0] >> 24).tolist())) == 150 and (tiny[2] == 0xFFFFFFFF).all()


def test_word_hashes_agree_with_words():
    r = random.Random(4)
    texts = ["".join(r.choice("aB c\t\n\x0b\x1f\x85é漢") for _ in range(r.randint(0, 60))) for _ in range(300)] + ["", " ", "x"]
    known = {}
    for t, h in zip(texts, words_of_batch([t.encode() for t in texts]), strict=True):
        w = WORD.findall(lower(t))
        assert len(w) == len(h) and (word_hashes(t.encode()) == h).all()
        for x, y in zip(w, h.tolist()):
            assert known.setdefault(x, y) == y
    assert len(set(known.values())) == len(known)
    assert len(shingles(word_hashes(b"a b"), 4)) == 1 and not len(shingles(word_hashes(b""), 4))


# --- decontamination ---


def test_decontamination(spark, prose, odd_docs, no_docs):
    r = random.Random(8)
    v = [f"q{i}z" for i in range(300)]
    items = [(i, " ".join(r.choice(v) for _ in range(n))) for i, n in enumerate((40, 25, 18, 6, 30))] + [(9, None), (10, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = {i: t.split() for i, t in items if t}
    swapped = [w if k % 9 else "other" for k, w in enumerate(words[0])]
    texts = {100: "start " + items[0][1].upper() + " end", 101: " ".join(swapped), 102: " ".join(words[4][5:20]), 103: " ".join(words[4][5:13]), 104: "x " + items[3][1] + " y", 105: " ".join(r.sample(words[1], 25))}
    table = prose.unionByName(spark.createDataFrame([(i, t, None, None, None) for i, t in texts.items()], prose.schema))
    got = {x.doc_id: x for x in decontaminate.decontaminate(table, bench).collect()}
    assert [i for i, x in sorted(got.items()) if x.contaminated] == [100, 101, 102, 104]
    assert got[100]["items"] == [0] and got[100].matches == [40] and got[100].spans == [[1, 41]] and got[101].matches[0] >= 35
    joined = {x.doc_id: x for x in decontaminate.decontaminate(table, bench, block_bytes=200).collect()}
    assert joined == got
    assert decontaminate.decontaminate(odd_docs, bench).where("contaminated").count() == 0
    assert decontaminate.decontaminate(no_docs, bench).count() == 0
    assert decontaminate.decontaminate(table, bench.limit(0)).where("contaminated").count() == 0


def test_overlaps_equal_brute_force_at_all_places():
    r = random.Random(11)
    word = lambda: r.getrandbits(60)
    hashed = lambda w: np.array(w, dtype=np.uint64)

    def check(text, item):
        got = decontaminate.best_of(decontaminate.Index([(7, hashed(item))]), [hashed([])] + [hashed(text)], 13, 0.8).get(1, [])
        want = best_overlap(text, item)
        assert [tuple(x) for x in got] == ([(7, *want)] if want else []), (text, item)
        return want

    for n in range(1, 22):
        for where in [w for k in range(3) for w in itertools.combinations(range(n), k)]:
            item = [word() for _ in range(n)]
            text = [word() for _ in range(r.choice([0, 3]))] + [word() if k in where else w for k, w in enumerate(item)] + [word() for _ in range(r.choice([0, 2]))]
            found = check(text, item)
            assert found or len(where) > n // 5 or n >= decontaminate.LONG
    for _ in range(200):  # few words, so many alignments
        check([r.randrange(3) for _ in range(r.randint(0, 60))], [r.randrange(3) for _ in range(r.randint(1, 16))])


def test_overlaps_list_alignments_in_pieces(monkeypatch):
    monkeypatch.setattr(decontaminate, "HITS", 50)
    monkeypatch.setattr(decontaminate, "COMPARED", 60)
    same, item = np.full(500, 9, dtype=np.uint64), np.full(20, 9, dtype=np.uint64)
    assert decontaminate.best_of(decontaminate.Index([(1, item)]), [same], 13, 0.8) == {0: [(1, 20, 0, 20)]}


# --- tokens ---


def test_bpe_equals_the_library(spark, odd_docs, no_docs):
    tiktoken = pytest.importorskip("tiktoken")
    with open(RANKS, "rb") as f:
        ranks = bpe.parse_ranks(f.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    shared = bpe.broadcast_ranks(spark, RANKS)
    r = random.Random(6)
    extra = ["".join(r.choice("abcde 019 \n\t\x1c\x85 éß漢🎉'tsre.,-_  ") for _ in range(r.randint(0, 80))) for _ in range(300)]
    table = odd_docs.unionByName(spark.createDataFrame([(100 + i, t, None, None, None) for i, t in enumerate(extra)], odd_docs.schema))
    rows = bpe.decode(bpe.encode(table, shared, public_tokenizers.PATTERN, carry=("text",)), shared).collect()
    assert len(rows) == table.count()
    for x in rows:
        assert x.tokens == library.encode_ordinary(x.text or "") and bytes(x.decoded) == (x.text or "").encode()
    once = bpe.encode(table, shared, public_tokenizers.PATTERN, carry=("text",), decoded=True).collect()
    assert sorted(map(str, once)) == sorted(map(str, bpe.decode(bpe.encode(table, shared, public_tokenizers.PATTERN, carry=("text",)), shared).collect()))
    assert bpe.encode(no_docs, shared, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(KeyError):
        bpe.Decoder(ranks).decode_batch(np.array([60_000]), np.array([0, 1]))


def test_prefix_encoding_appends_and_edits():
    with open(RANKS, "rb") as f:
        v = bpe.Vocabulary(bpe.parse_ranks(f.read()))
    r = random.Random(7)
    for _ in range(60):
        data = bytes(r.choice(b"aaathe ingoub-") for _ in range(r.randint(1, 300)))
        p = bpe.PrefixEncoding(v, data)
        a = r.randint(0, len(data))
        b = r.randint(a, len(data))
        new = bytes(r.choice(b"theing") for _ in range(r.randint(0, 5)))
        done = p.replace(a, b, new)
        q = bpe.PrefixEncoding(v)
        for c in data[:a] + new + data[b:]:
            q.append(bytes([c]))
        assert p.last == q.last and p.data == q.data and b"".join(v.bytes[t] for t in p.tokens()) == p.data
        assert done <= len(p.data) - a


# --- languages, quality, licences ---


def test_language_identification(spark, odd_docs, no_docs, docs_schema):
    r = random.Random(9)
    parts = {"aa": ["the", "ing", "wh", "ed"], "bb": ["eau", "oi", "le", "é"], "cc": ["sch", "ung", "ö", "ein"]}
    rows = []
    for i in range(400):
        lang = r.choice(list(parts))
        text = " ".join("".join(r.choice(parts[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(3, 40)))
        rows.append((i, text, lang if i % 5 else None, None, len(text)))
    table = spark.createDataFrame(rows, docs_schema)
    model = langid.fit(langid.train_part(table).select("text", "lang"))
    got = langid.identify(table, model, carry=("doc_id", "lang")).withColumn("h", langid.held_out()).where("h and lang is not null").collect()
    assert len(got) > 60 and sum(x.lang == x.lang_pred for x in got) / len(got) > 0.97 and all(0 <= x.score <= 1 for x in got)
    odd = langid.identify(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and {x.lang_pred for x in odd if x.doc_id in (3, 4, 5, 8)} == {"und"}
    assert langid.fit(no_docs) is None and {x.lang_pred for x in langid.identify(odd_docs, None).collect()} == {"und"}
    assert langid.identify(no_docs, model).count() == 0


def test_kernel_scores_equal_the_unfolded_form():
    texts = ["the thing", "le eau oi", "das ist", "then and there", "la oie"]
    model = langid.fit_texts(texts, ["a", "b", "c", "a", "b"], landmarks=4)
    grams = lambda t, n: {t.encode()[i : i + n] for i in range(len(t.encode()) - n + 1)}
    kernel = lambda x, y: np.mean([len(grams(x, n) & grams(y, n)) / np.sqrt(len(grams(x, n)) * len(grams(y, n))) for n in (1, 2, 3)])
    assert abs(kernel("the thing", "the thing") - 1) < 1e-12
    # the folded score is linear in the kernel with the landmarks
    k = np.array([[kernel(x, y) for y in texts[:4]] for x in texts])
    s = langid.Scorer(model)
    raw = []
    for t in texts:
        sets = s.grams.distinct(t)
        raw.append(model.bias + sum(model.weights[o][[i for i in s.tables[o][sets[o]] if i >= 0]].sum(axis=0) / np.sqrt(len(sets[o])) for o in range(3)))
    raw = np.array(raw) - model.bias
    coef, *_ = np.linalg.lstsq(k, raw, rcond=None)
    assert np.abs(k @ coef - raw).max() < 1e-5


def test_quality(spark, odd_docs, no_docs, docs_schema):
    r = random.Random(10)
    v = ["".join(r.choice("abdeghilmnorst") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(500):
        bad, toxic = i % 5 == 0, i % 7 == 0
        words = [r.choice(v) for _ in range(60)]
        if bad:
            words = [w.upper() + "!!" for w in words[:10]] * 6
        if toxic:
            words[10] = words[30] = "badword" + r.choice("abc")
        rows.append((i, " ".join(words), "en", f"s{i % 3}", 1))
        labels.append((i, int(not bad), int(toxic)))
    table = spark.createDataFrame(rows, docs_schema)
    marks = spark.createDataFrame([*labels[:350], (None, 1, 0), (3, None, None), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    models = quality.fit(table, marks)
    got = {x.doc_id: x for x in quality.classify(table, models).collect()}
    right = [got[i].kept == (q == 1 and t == 0) for i, q, t in labels[350:]]
    assert sum(right) / len(right) > 0.95
    odd = quality.classify(odd_docs, models).collect()
    assert len(odd) == odd_docs.count() and all(0 <= x.quality <= 1 and 0 <= x.toxicity <= 1 for x in odd)
    assert quality.classify(no_docs, models).count() == 0
    none = quality.fit(table, marks.limit(0))
    assert all(x.kept for x in quality.classify(table, none).collect())


def test_quality_sample_is_bounded(spark, docs_schema, monkeypatch):
    """A repeated document and one with thousands of labels count once."""
    met = []
    monkeypatch.setattr(quality, "fit_logistic", lambda rows, y, *a, real=quality.fit_logistic: met.append(len(rows)) or real(rows, y, *a))
    docs = spark.createDataFrame([(7, "the same text", "en", "s", 13)] * 5000 + [(i, f"text {i}", "en", "s", 7) for i in range(100, 140)] + [(None, "x", None, None, None)], docs_schema)
    labels = spark.createDataFrame([(7, 1, 0)] * 3000 + [(i, i % 2, 0) for i in range(100, 140)], "doc_id long, quality int, toxic int")
    quality.fit(docs, labels, sample=30)
    quality.fit(docs, labels)
    assert met == [30, 30, 41, 41]


def test_quality_equals_brute_force(spark, docs_schema):
    r = random.Random(13)
    rows = [(i if i % 11 else None, " ".join(r.choice(["good", "BAD!!", "fine", "12"]) for _ in range(r.randint(0, 9))), r.choice(["a", "b", None]), r.choice(["s", "t", "u", None]), 1) for i in range(300)]
    flat = quality.Logistic(np.zeros(7), np.ones(7), np.array([0.1, 0, 0, -2, -3, -2.0, 0.3]), np.empty(0, np.uint64), np.empty(0), 0.4)
    calm = quality.Logistic(np.zeros(7), np.ones(7), np.zeros(7), np.empty(0, np.uint64), np.empty(0), -30.0)
    got = sorted(map(str, quality.classify(spark.createDataFrame(rows, docs_schema), (flat, calm)).select("doc_id", F.round("path_quality", 9), F.round("quality", 9), "kept").collect()))
    p = [1 / (1 + math.exp(-flat.logit(*quality.measures(t.encode())))) for _, t, *_ in rows]
    rate = sum(p) / len(p)

    def sums(key):
        out = {}
        for x, row in zip(p, rows):
            n, s = out.get(key(row), (0, 0.0))
            out[key(row)] = (n + 1, s + x)
        return out

    def prior(groups, above):
        between = sum(n * (s / n - above(k)) ** 2 for k, (n, s) in groups.items()) / len(p) - len(groups) / len(p) * rate * (1 - rate)
        return min(1e6, max(1.0, rate * (1 - rate) / max(between, 1e-9) - 1))

    hosts, paths = sums(lambda x: x[3]), sums(lambda x: (x[3], x[2]))
    k_host = prior(hosts, lambda _: rate)
    k_path = prior(paths, lambda k: (hosts[k[0]][1] + k_host * rate) / (hosts[k[0]][0] + k_host))
    want = []
    for x, row in zip(p, rows):
        (n, s), (m, t) = hosts[row[3]], paths[row[3], row[2]]
        host = (s - x + k_host * rate) / (n - 1 + k_host)
        path = (t - x + k_path * host) / (m - 1 + k_path)
        odds = x / (1 - x) * path / (1 - path) / rate * (1 - rate)
        want.append((row[0], path, odds / (1 + odds)))
    table = spark.createDataFrame(want, "doc_id long, path_quality double, quality double").select("doc_id", F.round("path_quality", 9), F.round("quality", 9), (F.col("quality") >= 0.5).alias("kept"))
    assert got == sorted(map(str, table.collect()))


def test_sparse_sites_shrink(spark, docs_schema):
    flat = quality.Logistic(np.zeros(7), np.ones(7), np.array([0, 0, 0, 0, 0, -60.0, 0]), np.empty(0, np.uint64), np.empty(0), 3.0)
    rows = [(i, "good text here", "en", "big", 1) for i in range(200)] + [(1000 + i, "GOOD TEXT", "en", "bad", 1) for i in range(200)] + [(2000, "GOOD TEXT", "en", "rare", 1)]
    got = {x.doc_id: x for x in quality.classify(spark.createDataFrame(rows, docs_schema), (flat, quality.fit_logistic([], np.empty(0)))).collect()}
    assert got[1000].host_quality < got[2000].host_quality < got[0].host_quality


def test_license_scan(spark, odd_docs, no_docs):
    rows = [(1, "Released under the MIT License."), (2, "mit  LICENSE, apache-license; mit license"), (3, "the licensed mit"), (4, "Licensed under CC BY-NC 4.0. General\npublic license"), (5, None), (6, "")]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels, got[1].labels) == (5, 1, 3, 3, "mit", "mit") and got[1].score == pytest.approx(1.0)
    assert (got[2].n_base, got[2].first_word, got[2].last_word, got[2].base_labels) == (3, 0, 4, "apache,mit")
    assert got[3].n_base == 0 and got[3].first_word is None and got[3].labels == "" and got[3].score == 0
    assert got[4].base_labels == "gpl" and got[4].labels == "cc-by-nc-4.0,gpl"
    assert got[5].n_words == got[6].n_words == 0
    more = license_scan.read_templates(spark.createDataFrame([("own", "you may use this for any purpose", "any purpose", False), ("one", "zlib", "zlib", True)], "label string, words string, key string, base boolean"))
    seen = license_scan.scan_licenses(spark.createDataFrame([(1, "You may use this for ANY purpose."), (2, "purpose any"), (3, "any any purpose zlib")], "doc_id long, text string"), templates=more)
    assert {r.doc_id: (r.labels, r.n_base) for r in seen.collect()} == {1: ("own", 0), 2: ("", 0), 3: ("one", 1)}
    assert license_scan.scan_licenses(odd_docs).count() == odd_docs.count() and license_scan.scan_licenses(no_docs).count() == 0


def test_sha_of_empty():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_language_sample_of_one_repeated_text(spark, docs_schema):
    for text in ("the same words", "der gleiche Text", "un seul texte", "x"):
        docs = spark.createDataFrame([(i, text, "aa", "s", 1) for i in range(5000)], docs_schema)
        model = langid.fit(langid.train_part(docs).select("text", "lang"))
        assert model.languages == ("aa",)
        assert {(r.lang_pred, r.n) for r in langid.identify(docs, model).groupBy("lang_pred").agg(F.count("*").alias("n")).collect()} == {("aa", 5000)}


def test_kernel_ridge_equals_an_unfolded_solve():
    """Scores against the kernel matrices written out, with Nystroem features by an eigendecomposition of their own."""
    r = random.Random(14)
    texts = ["".join(r.choice("abcdé ") for _ in range(r.randint(5, 40))) for _ in range(60)]
    langs = [("x", "y", "z")[t.count("a") % 3] for t in texts]
    model = langid.fit_texts(texts, langs, landmarks=25)

    def grams(t, n):
        b = t.lower().encode()
        return {b[i : i + n] for i in range(len(b) - n + 1)}

    def kernel(s, t):
        return sum(len(grams(s, n) & grams(t, n)) / math.sqrt(len(grams(s, n)) * len(grams(t, n))) for n in langid.ORDERS) / 3

    k = np.array([[kernel(s, t) for t in texts[:25]] for s in texts])
    value, vector = np.linalg.eigh(k[:25])
    phi = k @ vector[:, value > 1e-8] / np.sqrt(value[value > 1e-8])
    weight = np.array([1 / langs.count(x) for x in langs])
    weight *= len(texts) / weight.sum()
    root = np.sqrt(weight)[:, None]
    for c, lang in enumerate(model.languages):
        y = np.where(np.array(langs) == lang, 1.0, -1.0)
        # an unpenalised intercept as one more column, solved as least squares with the penalty as rows
        x = np.column_stack([phi, np.ones(len(texts))])
        penalty = np.sqrt(langid.RIDGE * len(texts) / 100) * np.eye(x.shape[1])[:-1]
        beta, *_ = np.linalg.lstsq(np.vstack([root * x, penalty]), np.concatenate([root[:, 0] * y, np.zeros(len(penalty))]), rcond=None)
        own = langid.Scorer(model)
        got = [model.bias[c] + sum(float(model.weights[o][[i for i in own.tables[o][s] if i >= 0], c].sum()) / math.sqrt(len(s)) for o, s in enumerate(own.grams.distinct(t))) for t in texts]
        assert np.abs(x @ beta - got).max() < 1e-4


def test_language_sample_has_every_language(spark):
    rows = [("the same words again and again", "en")] * 400 + [(f"der text nummer {i} ist ganz kurz und klein", "de") for i in range(300)] + [("une phrase courte en langue rare", "fr")]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"), sample=20)
    assert model.languages == ("de", "en", "fr")
    assert langid.quotas({"a": 1, "b": 500, "c": 600}, 21) == {"a": 1, "b": 10, "c": 10}
