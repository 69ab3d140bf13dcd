"""Jaccard join, vectors, URL rules and the pipeline against plain versions."""

import collections
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import ngram_join, quality, url_rules, vectors
from tidemark.llm.components import components
from tidemark.llm.queries import URL_RULES


def union(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def plain_components(sets, percent=75):
    links = []
    for (a, x), (b, y) in itertools.combinations(sets.items(), 2):
        shared = len(x & y)
        if shared and 100 * shared >= percent * (len(x) + len(y) - shared):
            links.append((a, b))
    return union(sets, links)


def near_copies(seed, families, size):
    """Families of copies with some words changed, so that some are linked directly, some by others and some not at all."""
    draw, texts = random.Random(seed), []
    for f in range(families):
        base = [f"f{f}w{k}" for k in range(60)]
        for _ in range(size):
            copy = list(base)
            for _ in range(draw.randrange(4)):
                copy[draw.randrange(60)] = f"z{draw.randrange(10**6)}"
            texts.append(" ".join(copy))
    passage = " ".join(f"p{k}" for k in range(20))
    return texts + [f"{passage} " + " ".join(f"q{j}x{k}" for k in range(30)) for j in range(30)]


def test_components(spark, rows):
    draw = random.Random(1)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 340)] + [(500, k) for k in range(501, 600)]
    found = dict(rows(components(spark.createDataFrame(edges, "a long, b long"))))
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    assert found == union(nodes, [e for e in edges if e[0] != e[1]])
    assert rows(components(spark.createDataFrame([], "a long, b long"))) == []


def test_jaccard_components(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FLUSH_DOCS", 40)
    texts = near_copies(2, 6, 25)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: (r.size, r.component_id) for r in ngram_join.similar_sets(docs).collect()}
    sets = {k: shingles(t) for k, t in enumerate(texts)}
    roots = plain_components(sets)
    assert found == {k: (len(sets[k]), roots[k]) for k in sets}


def test_jaccard_threshold_is_inclusive(spark):
    words = [f"a{k}" for k in range(104)]
    one, two = " ".join(words), " ".join([*words[:-1], "other"])
    # 100 shingles each; 99 shared of 101
    three = " ".join(words[:79])  # 75 shingles, all shared: exactly 75 percent
    four = " ".join(words[:78])  # 74 of 100
    docs = spark.createDataFrame([(1, one), (2, two), (3, three)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.similar_sets(docs).collect()} == {1: 1, 2: 1, 3: 1}
    docs = spark.createDataFrame([(1, one), (4, four)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.similar_sets(docs).collect()} == {1: 1, 4: 4}


def test_jaccard_edge_cases(docs, no_docs):
    found = collections.defaultdict(list)
    for r in ngram_join.similar_sets(docs).collect():
        found[r.doc_id].append((r.size, r.component_id))
    assert found[1][0][1] == found[2][0][1] == found[3][0][1] == 1
    assert found[4] == [(0, 4)] and found[5] == [(0, 5)] and found[6] == [(0, 6)] and found[7] == [(1, 7)]
    assert len(found[9]) == 2 and len(found[None]) == 2
    assert ngram_join.similar_sets(no_docs).collect() == []
    stay = sorted(r.doc_id or -1 for r in ngram_join.one_of_each(docs).collect())
    assert stay == sorted([-1, -1, 1, 4, 5, 6, 7, 8, 9, 12, 13, 14, 15, 16])
    assert ngram_join.one_of_each(docs).columns == docs.columns


def test_vector_links(spark):
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for label in (1, 2):
        for _ in range(60):
            centre = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 8))):
                rows.append((n, [float(x) for x in centre + rng.normal(size=16) * 0.18], label))
                n += 1
    odd = [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] * 16, 1), (n + 3, rows[0][1], None), (n + 4, [], 1), (n + 5, [None] + [1.0] * 15, 1)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").repartition(3)
    found = {r.vec_id: r for r in vectors.near_duplicates(table, shard=64).collect()}
    unit = np.array([np.array(v) / np.linalg.norm(v) for _, v, _ in rows])
    same = np.array([r[2] for r in rows])
    linked = (unit @ unit.T >= 0.93) & (same[:, None] == same[None, :])
    np.fill_diagonal(linked, False)
    got = sum(found[k].n_links for k in range(len(rows)))
    assert 0.9 * linked.sum() <= got <= linked.sum()
    assert all(found[k].n_links <= linked[k].sum() for k in range(len(rows)))
    roots = union(range(len(rows)), zip(*np.nonzero(np.triu(linked)), strict=True))
    assert sum(found[k].component_id != roots[k] for k in range(len(rows))) <= 0.02 * len(rows)
    assert all(found[k].n_links == 0 and found[k].component_id == k and found[k].kept for k in range(n, n + 6))
    assert vectors.near_duplicates(table.where("false")).collect() == []


def test_large_group_of_copies_is_found_whole(spark):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=8)
    rows = [(k, [float(x) for x in centre + rng.normal(size=8) * 0.01], 1) for k in range(400)]
    found = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), shard=128).collect()
    assert all(r.component_id == 0 for r in found)
    assert sum(r.n_links for r in found) >= 0.98 * 400 * 399


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    return host, tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]


def test_url_rules(spark):
    urls = [
        None, "", "no scheme", "http://EXAMPLE.org/es/x", "https://a.example.org/en/12?q#f", "https://a.example.org/en/2", "http://notexample.org/es/", "ftp://x.com/fr/y",
        "http://x.com/de/", "http://com/de/y", "http://x.com?/de/", "http://x.com", "a://b://c/d", "http://ÄB.com/fr/", "http://x.net/\nde#y?z",
    ]
    pages = spark.createDataFrame([(k, u, None, k) for k, u in enumerate(urls)] + [(None, "http://q.org/", None, 0)], "page_id long, url string, html string, rule int")
    mined = spark.createDataFrame([(["h:x.com"], "h:x.com", 0.9, 0.1)], "tokens array<string>, anchor string, confidence double, support double")
    found = {r.page_id: r for r in url_rules.judge(pages, URL_RULES, mined).collect()}
    for k, u in enumerate(urls):
        host, path = plain_url(u)
        fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if ("." + host).endswith("." + h) and path.startswith(p)]
        rule, verdict = max(fits)[1:] if fits else (None, "block" if host == "x.com" else "allow")
        assert (found[k].host, found[k].path, found[k].rule, found[k].verdict) == (host, path, rule, verdict), u
    assert found[None].rule == "org/"


def plain_rules(baskets, least, confidence):
    """All least combinations of tokens, by trying every one that a bad page holds."""
    held = {c for tokens, bad in baskets if bad for size in range(1, len(tokens) + 1) for c in itertools.combinations(sorted(tokens), size)}
    good = {}
    for tokens in held:
        marks = [bad for own, bad in baskets if set(tokens) <= own]
        if sum(marks) >= least and sum(marks) >= confidence * len(marks):
            good[tokens] = sum(marks) / len(marks)
    return {t: c for t, c in good.items() if not any(set(o) < set(t) for o in good)}


def labelled_pages(spark, urls):
    pages = spark.createDataFrame([(k, url) for k, (url, _) in enumerate(urls)], "page_id long, url string")
    return pages, spark.createDataFrame([(k, 1 - bad, 0) for k, (_, bad) in enumerate(urls)], "doc_id long, quality long, toxic long")


def test_url_rules_equal_all_least_combinations(spark):
    rng = random.Random(5)
    urls = []
    for _ in range(150):
        keys = rng.sample("abcdefg", 4)
        bad = int({"a", "b"} <= set(keys) or ("c" in keys and rng.random() < 0.7) or rng.random() < 0.1)
        urls.append((f"http://h{rng.randrange(3)}.com/?" + "&".join(f"{k}=1" for k in keys), bad))
    pages, labels = labelled_pages(spark, urls)
    tokens = {r.page_id: set(r.t) for r in pages.select("page_id", url_rules.url_tokens(F.col("url")).alias("t")).collect()}
    # h:x and d:x are on the same pages and count as one
    baskets = [({t for t in tokens[k] if not t.startswith("h:")}, bad) for k, (_, bad) in enumerate(urls)]
    mined = url_rules.mine_rules(pages, labels)
    rules = {tuple(sorted(r.tokens)): r.confidence for r in mined.collect()}
    expected = plain_rules(baskets, 5, 0.6)
    assert rules.keys() == expected.keys() and len(rules) > 3
    assert all(abs(rules[t] - expected[t]) < 1e-12 for t in rules)
    verdicts = {r.page_id: r.verdict for r in url_rules.judge(pages, [], mined).collect()}
    assert verdicts == {k: "block" if any(set(t) <= tokens[k] for t in expected) else "allow" for k in tokens}


def test_url_rules_of_many_keys_end(spark):
    rng = random.Random(6)
    urls = [("http://x.com/?" + "&".join(f"k{k}=1" for k in range(28) if rng.random() < 0.5), int(rng.random() < 0.4)) for _ in range(120)]
    mined = url_rules.mine_rules(*labelled_pages(spark, [*urls, (None, 1), ("", 0), ("http://y.com/" + "a/" * 5_000, 1)]))
    assert all(len(r.tokens) > 0 for r in mined.collect())
    assert url_rules.judge(spark.createDataFrame([], "page_id long, url string"), [], mined).count() == 0


def test_url_rules_hold_on_other_pages(spark):
    rng = random.Random(7)
    urls = []
    for _ in range(400):
        host, ad = f"s{rng.randrange(40)}", rng.random() < 0.3
        urls.append((f"http://{host}.com/a{rng.randrange(9)}" + ("?aff=1&pop=2" if ad else "?aff=1" if rng.random() < 0.6 else "?q=1"), int(ad ^ (rng.random() < 0.05))))
    pages, labels = labelled_pages(spark, urls)
    mined = url_rules.mine_rules(pages, labels.where("doc_id < 250"))
    verdicts = {r.page_id: r.verdict for r in url_rules.judge(pages, [], mined).collect()}
    right = [(verdicts[k] == "block") == bool(bad) for k, (_, bad) in enumerate(urls) if k >= 250]
    assert sum(right) / len(right) > 0.9


def test_url_rules_are_mined(spark):
    pages, labels = [], []
    for k in range(400):
        spam = k % 10 == 0
        pages.append((k, f"http://{'cheap-pills' if spam else f'site{k % 7}'}.net/en/{k}{'?buy=1' if k % 5 == 0 else ''}"))
        labels.append((k, 0 if spam else 1, None))
    labels += [(None, 0, 1), (5000, 0, 1), (3, None, None)]
    pages += [(None, "http://cheap-pills.net/"), (401, None)]
    pages, labels = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    mined = url_rules.mine_rules(pages, labels)
    verdicts = {r.page_id: r.verdict for r in url_rules.judge(pages, [], mined).collect()}
    assert all(verdicts[k] == ("block" if k % 10 == 0 else "allow") for k in range(400)) and verdicts[None] == "block" and verdicts[401] == "allow"
    assert url_rules.mine_rules(pages.where("false"), labels).count() == 0


def test_pipeline_stages(spark, sample, tmp_path):
    columns = sample.columns
    docs, seen = sample, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        path = f"{tmp_path}/{name.replace(' ', '_')}"
        out.write.parquet(path)
        seen.append((name, docs, spark.read.parquet(path)))
        docs = seen[-1][2]
    ids = lambda df: [r.doc_id for r in df.select("doc_id").collect()]
    _, before, after = seen[0]
    assert after.columns == columns
    assert set(ids(after)) == {r.doc_id for r in quality.judged(before).collect() if r.kept}
    _, before, after = seen[1]
    sets = {r.doc_id: shingles(r.text) for r in before.collect()}
    roots = plain_components(sets)
    assert sorted(ids(after)) == sorted(k for k in sets if roots[k] == k)
    _, before, after = seen[2]
    assert after.columns == columns and sorted(ids(before)) == sorted(ids(after))
    assert after.where(F.col("text").rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")).count() == 0
    _, before, after = seen[3]
    assert after.columns == columns and set(ids(after)) <= set(ids(before))
    _, before, after = seen[4]
    assert sorted(ids(before)) == sorted(ids(after)) and after.where("n_tokens = 0").count() == 0


@pytest.mark.parametrize("table", ["docs", "no_docs"])
def test_pipeline_stages_take_odd_tables(spark, request, table):
    docs = request.getfixturevalue(table)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        out.count()
    assert stage(spark, docs, "").count() >= 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()
