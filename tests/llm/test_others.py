"""URL rules, embeddings, links and the pipeline."""

import random
import re

import numpy as np
import pandas as pd
import pytest
from brute import best_overlap
from pyspark.sql import functions as F

import corpus_pipeline
from courtside.llm import bpe, langid, near_vectors, url_filter
from courtside.llm.common import components
from courtside.llm.queries import URL_RULES

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest, re.S)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :], re.S)[0]


def judge(host, path, rules):
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, "allow")


def test_url_rules(spark):
    r = random.Random(1)
    rules = [*URL_RULES, *[(".".join(r.choice(["a", "b", "c"]) for _ in range(r.randint(1, 4))), "/" + "x" * r.randint(0, 3), r.choice(["allow", "block"])) for _ in range(60)]]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.org/es/1?x#y", "http://org/", "http://xorg/", "http://a.b?c", "http://ä.ORG/é", "http://e.com:80/fr/"]
    urls += ["http://" + ".".join(r.choice(["a", "b", "c", "x"]) for _ in range(r.randint(1, 5))) + "/" + "x" * r.randint(0, 4) for _ in range(600)]
    table = spark.createDataFrame([(i, u, "rule") for i, u in enumerate(urls)] + [(None, None, None)], "page_id long, url string, rule string")
    for size in (url_filter.BLOCK_BYTES, 2000):
        got = {x.page_id: x for x in url_filter.filter_urls(table.select("page_id", "url"), rules, block_bytes=size).collect()}
        for i, u in enumerate(urls):
            host, path = split_url(u)
            rule, verdict = judge(host, path, rules)
            assert (got[i].host, got[i].path, got[i].verdict) == (host, path, verdict), u
            assert (got[i].rule is None) == (rule is None) and len(got[i].rule or "") == len(rule or "")
    twice = url_filter.filter_urls(table.unionByName(table), rules).groupBy("page_id", "host", "path", "rule", "verdict").count()
    assert {x["count"] for x in twice.where("page_id is not null").collect()} == {2}
    assert url_filter.filter_urls(table, rules).count() == len(urls) + 1
    assert url_filter.filter_urls(table.limit(0), rules).count() == 0


def test_many_paths_at_one_host_cost_their_nesting(spark, monkeypatch):
    r = random.Random(12)
    path = lambda: "/" + "/".join(r.choice("abcdef") * r.randint(1, 3) for _ in range(r.randint(1, 6)))
    rules = list({("big.org", p): ("big.org", p, r.choice(["allow", "block"])) for p in (path() for _ in range(10_000))}.values()) + [("org", "", "allow"), ("a.big.org", "/a", "block")]
    by_path = {p: v for h, p, v in rules if h == "big.org"}
    urls = [(r.choice(["big.org", "a.big.org", "x.a.big.org", "bigg.org", "org"]), path()) for _ in range(400)]

    def want(host, p):
        fits = [(len("org"), 3, "org", "allow")]
        if host == "big.org" or host.endswith(".big.org"):
            fits += [(7 + n, 7, "big.org" + p[:n], by_path[p[:n]]) for n in range(len(p) + 1) if p[:n] in by_path]
        if host.endswith("a.big.org") and p.startswith("/a"):
            fits.append((11, 9, "a.big.org/a", "block"))
        return max(fits)[2:]

    for jump in (url_filter.JUMP, 10**9):
        monkeypatch.setattr(url_filter, "JUMP", jump)
        rule, verdict = url_filter.RuleSweep(rules).sweep([url_filter.reversed_key(h) for h, _ in urls], [p for _, p in urls])
        assert list(zip(rule, verdict)) == [want(*u) for u in urls]


def brute(rows, threshold):
    n = len(rows)
    near = [set() for _ in rows]
    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if a[2] is None or a[2] != b[2] or not (usable(a[1]) and usable(b[1])) or len(a[1]) != len(b[1]):
                continue
            x, y = np.array(a[1], float), np.array(b[1], float)
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                near[i].add(j)
                near[j].add(i)
    low = list(range(n))
    while True:
        new = [min([low[i], *(low[j] for j in near[i])]) for i in range(n)]
        if new == low:
            return near, low
        low = new


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_near_vectors(spark):
    r = np.random.default_rng(3)
    rows = []
    for c in range(30):
        base = r.normal(size=16)
        for _ in range(r.integers(1, 14)):
            rows.append(((base + r.normal(size=16) * 0.12).astype(np.float32).tolist(), int(c % 3)))
    rows += [(rows[0][0], rows[0][1])] * 3 + [(rows[5][0], None), (None, 1), ([0.0] * 16, 1), ([float("nan")] * 16, 1), ([float("inf")] + [1.0] * 15, 1), ([None] + [1.0] * 15, 1), ([], 1), ([1.0, 2.0], 1), ([1.0, 2.0], 1)]
    rows = [(i, v, l) for i, (v, l) in enumerate(rows)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    near, low = brute(rows, 0.98)
    for options in ({}, {"k": 2, "tables": 2, "block": 16, "tile": 4}):
        got = {x.vec_id: x for x in near_vectors.near_vectors(table, **options).collect()}
        assert [got[i].n_links for i in range(len(rows))] == [len(s) for s in near]
        assert [got[i].component_id for i in range(len(rows))] == low and all(got[i].kept == (low[i] == i) for i in got)
    assert near_vectors.near_vectors(table.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, [1.0, 0.0], 1, 5), (4, [1.0, 0.0], 1, 5), (4, [1.0, 0.0], 1, 5)], "vec_id long, embedding array<float>, label int, n_links int")
    assert sorted((x.vec_id or -1, x.n_links) for x in near_vectors.near_vectors(odd).collect()) == [(-1, 1), (4, 1), (4, 1)]


def test_near_vectors_links_of_tight_groups(spark):
    """Every vector has far more neighbours inside its own group than any neighbour list holds, and links with all of the other."""
    r = np.random.default_rng(8)
    a = r.normal(size=32)
    a /= np.linalg.norm(a)
    off = r.normal(size=32)
    off -= a * (a @ off)
    b = 0.9865 * a + np.sqrt(1 - 0.9865**2) * off / np.linalg.norm(off)
    rows = [(i, (c + r.normal(size=32) * 0.0003).tolist(), 1) for i, c in enumerate([a] * 100 + [b] * 100)]
    got = near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), tile=32).collect()
    assert len(got) == 200 and {x.n_links for x in got} == {199} and {x.component_id for x in got} == {0} and [x.vec_id for x in got if x.kept] == [0]


def test_near_vectors_audit_sees_rare_links(spark, caplog):
    """Six planted pairs among thousands of spread vectors: short lists miss some, and the audit must not take that for all."""
    r = np.random.default_rng(9)
    x = r.normal(size=(3000, 24))
    pairs = [v + r.normal(size=24) * 0.02 for v in x[:6]]
    rows = [(i, v.tolist(), 1) for i, v in enumerate([*x, *pairs])]
    got = near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), k=2, tables=1, block=4).collect()
    assert sorted((a.vec_id, a.component_id) for a in got if a.n_links) == sorted([(i, i) for i in range(6)] + [(3000 + i, i) for i in range(6)])


def test_near_vectors_with_poor_lists_are_compared_exactly(spark, monkeypatch):
    """Lists of one and no descent find few links, so the audit sends everything the exact way."""
    monkeypatch.setattr(near_vectors, "ROUNDS", 0)
    r = np.random.default_rng(10)
    rows = []
    for _ in range(60):
        base = r.normal(size=12)
        rows += [(base + r.normal(size=12) * 0.05).tolist() for _ in range(5)]
    rows = [(i, v, 0) for i, v in enumerate(rows)]
    near, low = brute(rows, 0.98)
    got = {a.vec_id: a for a in near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), k=1, tables=1, block=3, audit=100).collect()}
    assert [got[i].n_links for i in range(len(rows))] == [len(s) for s in near] and [got[i].component_id for i in range(len(rows))] == low


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low = {n: n for e in edges for n in e}
    for _ in range(400):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    assert got == {n: low[n] for e in edges if e[0] != e[1] for n in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def expected(rows, items, learned):
    """The pipeline's rows by brute force: (doc_id, lang, source, token ids), and how many rows each stage keeps."""
    big = 1 << 62
    own = lambda i: big if i is None else i
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    counts = []
    # language
    scorer = langid.Scorer(learned)
    rows = [(r.doc_id, r.text, r.lang or scorer.score([r.text])[0][0], r.source) for r in rows if r.text and any(c.isalpha() for c in r.text)]
    counts.append(len(rows))
    # lines
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for i, text, *_ in rows:
        for x in text.split("\n"):
            if len(key(x)) >= 10:
                holders.setdefault(key(x), set()).add(own(i))
    after = []
    for i, text, *rest in rows:
        stay = [x for x in text.split("\n") if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == own(i)]
        if "\n".join(stay).strip(" \t\n\x0b\x0c\r") or len(stay) == len(text.split("\n")):
            after.append((i, "\n".join(stay), *rest))
    rows = after
    counts.append(len(rows))
    # near copies
    texts = sorted({(own(i), t) for i, t, *_ in rows})
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := words(t)) else set() for _, t in texts]
    low = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(a):
                if low[a] != low[b] and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    low[a] = low[b] = min(low[a], low[b])
        if all(low[low[a]] == low[a] for a in range(len(texts))):
            break
    kept = {texts[a] for a in range(len(texts)) if low[a] == a}
    rows = [r for r in rows if (own(r[0]), r[1]) in kept]
    counts.append(len(rows))
    # benchmark
    rows = [r for r in rows if not any(best_overlap(words(r[1]), words(item)) for item in items)]
    counts.append(len(rows))
    with open(public_tokenizers.path(corpus_pipeline.RANKS), "rb") as f:
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(f.read()), special_tokens={})
    return [(i, lang, source, library.encode_ordinary(t)) for i, t, lang, source in rows], counts


def test_pipeline_equals_brute_force(spark, tmp_path, prose, odd_docs, caplog):
    caplog.set_level("INFO", logger="corpus_pipeline")
    r = random.Random(15)
    v = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    text = lambda n: " ".join(r.choice(v) for _ in range(n))
    items = [text(30), text(12), prose.where("length(text) > 200").orderBy("doc_id").first().text]
    swapped = " ".join(w if k % 9 else "other" for k, w in enumerate(items[0].split()))
    extra = [(3000, text(20) + " " + items[0].upper() + " " + text(5), None, "s", 1), (3001, swapped, "en", "s", 1), (3002, items[1], "en", "s", 1), (3003, "all of this\nstands elsewhere", "en", "s", 1), (2999, "ALL OF THIS \nmore of it\nstands elsewhere", "en", "s", 1)]
    docs = prose.unionByName(odd_docs.withColumn("doc_id", F.col("doc_id") + 1000)).unionByName(spark.createDataFrame(extra, prose.schema))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    learned = langid.fit(langid.train_part(frame).select("text", "lang"))
    want, counts = expected(frame.collect(), items, learned)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str((x.doc_id, x.lang, x.source, x.tokens)) for x in got) == sorted(map(str, want))
    assert all(x.round_trip and x.n_tokens == len(x.tokens) for x in got)
    assert not {1003, 1004, 1005, 1008, 3000, 3001, 3002, 3003} & {x.doc_id for x in got} and len(set(counts)) == 4
    assert [int(re.search(r"(\d+) rows", m)[1]) for m in caplog.messages if "keeps" in m] == counts


def test_pipeline_stages_keep_the_columns(spark, tmp_path, odd_docs):
    spark.createDataFrame([(0, "one two three four five six")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    names = list(corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd_docs, str(tmp_path)).columns == names and stage(spark, odd_docs.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, odd_docs.limit(0), str(tmp_path)).count() == 0
    assert len(corpus_pipeline.STAGES) == 5


def test_near_copies_go_row_by_row(spark, docs_schema):
    r = random.Random(4)
    text = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(80))
    base, other, alone = text(), text(), [text() for _ in range(4)]
    rows = [(1, base), (None, base), (None, base + " more"), (2, other), (3, other), (3, alone[0]), *[(None, t) for t in alone[1:]]]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], docs_schema)
    got = corpus_pipeline.near_copies(spark, docs, "").collect()
    assert sorted((x.doc_id or -1, x.text) for x in got) == sorted([(1, base), (2, other), (3, alone[0]), *[(-1, t) for t in alone[1:]]])


def test_language_stage_without_labels_keeps_letters(spark, docs_schema):
    long = "word " * 5000
    docs = spark.createDataFrame([(1, "some text", None, "s", 9), (2, "12 34", None, "s", 5), (3, None, None, "s", None), (4, long, "en", "s", len(long))], docs_schema)
    assert sorted((x.doc_id, x.lang) for x in corpus_pipeline.language(spark, docs, "").collect()) == [(1, None), (4, "en")]


def test_queries_have_oracles_that_agree(spark):
    duckdb = pytest.importorskip("duckdb")
    from courtside.llm import queries

    con = duckdb.connect()
    sf = "/root/testdata/sf0.001"
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for name, sql in queries.ORACLES.items():
        got, want = queries.QUERIES[name](spark, sf).toPandas(), con.sql(sql).df()
        cols = sorted(got.columns)
        assert cols == sorted(want.columns)
        plain = lambda v: None if pd.isna(v) else v if isinstance(v, str) else float(v)
        norm = lambda f: sorted(str([plain(v) for v in row]) for row in f[cols].astype(object).values.tolist())
        assert norm(got) == norm(want), name
