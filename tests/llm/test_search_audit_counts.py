"""Lexical search, filter audit and token counts against plain versions."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from tidemark.llm import filter_audit, search, token_counts

FILE = public_tokenizers.path("byte_bpe_50k.json")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ITEMS = "item_id long, text string, rank int, score long, n int"


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, k):
    held = [(doc_id, collections.Counter(plain_terms(text))) for doc_id, text in docs if plain_terms(text)]
    n_all, length_all = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    found = []
    for item_id, text in set(items):
        scored = []
        for doc_id, counts in held:
            m = 25 + (75 * sum(counts.values()) * n_all) // length_all
            score = 0
            for t in plain_terms(text):
                if counts[t]:
                    w = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        found += [(item_id, rank, None if no else d, -s) for rank, (s, no, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=str)


def test_terms():
    for text in ("Ab-c_d9é ÀB x\x7f\x80z[]^`{|}~/:;@?' q", "", "  ", "日本語 A1"):
        assert [t.decode() for t in search.terms_of(text)] == plain_terms(text)


def test_search_equals_brute_force(spark, docs, sample):
    for table, k in ((docs, 10), (docs, 1), (sample.select("doc_id", "text"), 10)):
        plain = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
        words = [w for _, t in plain for w in (t or "").split()[:30]]
        draw = random.Random(k)
        items = [(i, " ".join(draw.choices(words, k=8))) for i in range(12)]
        items += [(1, "fox fox fox dog"), (1, "fox fox fox dog"), (1, "w30"), (None, "satz mail THE"), (50, None), (51, ""), (52, "…?!"), (53, "nowhere9")]
        asked = spark.createDataFrame([(i, t, None, None, None) for i, t in items], ITEMS)
        got = search.search_documents(table, asked, k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == plain_search(plain, [(i, t) for i, t in items if t], k)


def test_search_of_nothing(spark, docs, no_docs):
    asked = spark.createDataFrame([(1, "fox", None, None, None)], ITEMS)
    assert search.search_documents(no_docs, asked).collect() == []
    assert search.search_documents(docs, asked.where("false")).collect() == []
    assert search.search_documents(docs.where("doc_id in (4, 5, 6)"), asked).collect() == []


def test_accumulators_are_limited_and_scores_exact():
    draw, limited = np.random.default_rng(3), 0
    for _ in range(300):
        n, k = int(draw.integers(1, 400)), int(draw.integers(1, 12))
        postings, order = {}, []
        for t in range(int(draw.integers(1, 9))):
            docs = np.flatnonzero(draw.random(n) < draw.choice([0.02, 0.2, 0.9])).astype(np.int32)
            if len(docs):
                # few different values, so that ties occur
                adds = draw.integers(1, 4, len(docs)) * int(draw.choice([1, 100, 1000]))
                postings[b"%d" % t] = docs, adds, int(adds.max())
                order.append((b"%d" % t, int(draw.integers(1, 3))))
        order.sort(key=lambda e: len(postings[e[0]][0]))
        whole = np.zeros(n, np.int64)
        for term, often in order:
            whole[postings[term][0]] += often * postings[term][1]
        docs, scores, created = search.ranked(postings, order, n, k)
        assert (whole[docs] == scores).all()
        # the best k with all that tie with the last of them
        positive = np.sort(whole[whole > 0])[::-1]
        expected = np.flatnonzero((whole > 0) & (whole >= (positive[k - 1] if len(positive) > k else 1)))
        assert sorted(docs.tolist()) == expected.tolist()
        limited += created < len(positive)
    assert limited > 30


def test_index_keeps_every_term(spark, docs, tmp_path):
    path = f"{tmp_path}/index"
    search.build_index(docs, path)
    lists = spark.read.parquet(path)
    plain = [collections.Counter(plain_terms(r.text)) for r in docs.select("text").collect()]
    assert lists.selectExpr("sum(n)").first()[0] == sum(map(len, plain))
    assert lists.selectExpr("sum(aggregate(times, 0, (a, b) -> a + b))").first()[0] == sum(sum(c.values()) for c in plain)


def plain_audit(docs, labels):
    firsts, marks = {}, collections.defaultdict(lambda: [False, False])
    for doc_id, text, _ in docs:
        if doc_id is not None:
            firsts[text or ""] = min(doc_id, firsts.get(text or "", doc_id))
    for doc_id, quality, toxic in labels:
        marks[doc_id][0] |= quality == 1
        marks[doc_id][1] |= toxic == 1
    marks[None] = [False, False]
    held = collections.defaultdict(list)
    for doc_id, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > firsts[text],
        }
        held[lang or ""].append(({f for f in fails if fails[f]}, *marks[doc_id]))
    found = []
    for part, rows in held.items():
        shapley, steps = collections.Counter(), []
        for order in itertools.permutations("ABCDE"):
            for at, letter in enumerate(order):
                before = set(order[:at])
                alive = [r for r in rows if not r[0] & before]
                gone = [r for r in alive if letter in r[0]]
                shapley[letter] += len(gone)
                counts = (
                    len(alive) - len(gone),
                    len(gone),
                    sum(letter in r[0] for r in rows) - len(gone),
                    sum(r[0] == {letter} for r in rows),
                    sum(r[1] for r in gone),
                    sum(r[2] for r in gone),
                )
                steps.append((part, "".join(order), at + 1, *counts, letter))
        found += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(found)


AUDITED = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_equals_plain_version(spark, docs, sample):
    schema = "doc_id long, quality int, toxic int, text string, lang string"
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (9, 1, 1), (None, 1, 1), (777, 1, 1), (15, None, None), (16, 0, 1), (14, 1, 1), (14, 1, 1)]
    table = spark.createDataFrame([(*row, None, None) for row in labels], schema)
    upper = spark.createDataFrame([(20, "ABC " * 300, "de", None), (21, "ABC " * 300, "", None), (21, "ABC " * 300, None, None)], "doc_id long, text string, lang string, word int")
    for given in (docs.unionByName(upper, allowMissingColumns=True), sample):
        got = filter_audit.audit(given, table)
        assert got.columns == AUDITED
        plain = [tuple(r) for r in given.select("doc_id", "text", "lang").collect()]
        assert sorted(tuple(r) for r in got.collect()) == plain_audit(plain, labels)


def test_audit_without_documents_or_labels(spark, docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(no_docs, labels).collect() == []
    rows = filter_audit.audit(docs, labels).collect()
    assert len(rows) == 600 * docs.selectExpr("coalesce(lang, '') AS p").distinct().count()
    assert all(r.good_lost == r.toxic_lost == 0 for r in rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 1000, 12_345])
def test_positional_popcount(n):
    words = np.random.default_rng(n).integers(0, 2**32, n, np.uint64).astype(np.uint32)
    plain = [int(((words >> np.uint32(b)) & 1).sum()) for b in range(32)]
    assert filter_audit.positional_popcount(words).tolist() == plain


def test_token_counts_equal_the_library(spark, docs, sample, no_docs):
    odd = ["one <|endoftext|> two<|endoftext|>x", "<|endoftext|><|endoftext|>", " a  b \n\n  c\t 　 d\x1c f", "'s 't ''s don't   '", "   ", "\n \ny  \r\n z ", "a\u0085 b <|endoftext"]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    library = Tokenizer.from_file(FILE)
    for table in (docs, more, sample):
        got = token_counts.count_tokens(table, FILE)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        plain = []
        for row in table.select("doc_id", "text").collect():
            n = len(library.encode(row.text or "", add_special_tokens=False).ids)
            plain.append((row.doc_id, len((row.text or "").encode()), n, n > 1024))
        assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(plain, key=str)
    assert token_counts.count_tokens(no_docs, FILE).collect() == []


def test_pre_tokens_count_as_in_their_text():
    known, library = token_counts.PreTokens(FILE), Tokenizer.from_file(FILE)
    draw = random.Random(5)
    for _ in range(300):
        text = "".join(draw.choices([" ", "a", "Bc", "é", "\n", "'s", "7", "!", "日", "　", "<|endoftext|>", " ", "\x1c"], k=14))
        pieces = token_counts.CUT.split(text)
        tokens = known.of_all(pieces, group=3)
        assert tokens == [known.of(p) for p in pieces]
        assert sum(known.count(t) for group in tokens for t in group) == len(library.encode(text, add_special_tokens=False).ids), text


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError):
        token_counts.PreTokens(public_tokenizers.path("word_bpe_49k.json"))
