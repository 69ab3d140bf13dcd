"""Secrets, personal data, quality, languages and mixing against plain versions."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid, mixing, pii, quality, secrets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def digest(spans):
    return hashlib.sha256(",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans)).encode()).hexdigest()


def secret_spans(t):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    return found + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]


def personal_spans(t):
    found = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if max(map(int, m[0].split("."))) <= 255]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        doubled = [int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))]
        if 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            found.append((m.start(), 2, "card", m.end()))
    phones = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
    return found + [(m.start(), 3, "phone", m.end()) for m in phones if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@pytest.mark.parametrize("table", ["docs", "sample", "no_docs"])
@pytest.mark.parametrize(("spans", "query"), [(secret_spans, lambda d: secrets.digests(secrets.scan(d))), (personal_spans, lambda d: pii.digests(pii.find(d)))])
def test_plain_spans(request, table, spans, query):
    docs = request.getfixturevalue(table)
    found = collections.Counter((r.doc_id, r.base_sha256) for r in query(docs).collect())
    assert found == collections.Counter((r.doc_id, digest(spans(r.text or ""))) for r in docs.collect())


def test_weak_secrets_need_their_complement(spark):
    weak = "aB3dE5gH7jK9mN1pQ3sT5vW7yZ9bC1dF3gHx"
    far = "filler words here " * 60
    texts = {
        1: f"blob {weak} alone",
        2: f"client_id = svc-44821 then {weak} at https://api.example.com/v1",
        3: f"client_id = svc-44821 {far} {weak}",
        4: "client_id = svc-44821 alone, see https://example.com",
        5: "token=abc12345 for https://example.com/x and nothing else",
    }
    found = {r.doc_id: [s["kind"] for s in r.spans] for r in secrets.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert found == {1: [], 2: ["weak_id", "weak_secret", "endpoint"], 3: [], 4: [], 5: ["weak_assign"]}


def test_linked_credentials(spark):
    weak = "aB3dE5gH7jK9mN1pQ3sT5vW7yZ9bC1dF3gHx"
    texts = {
        1: "see https://example.org/Data/Reports2024/QuarterlySummaryFinalVersion3 for more",
        2: f"client_id = svc-44821 then {weak} at https://api.example.com/v1 or https://api.example.com/v2",
        3: f"client_id = svc-44821, see https://example.org/Data/Reports2024/QuarterlySummaryFinalVersion3",
        4: f"{weak} at https://example.com/x",
        5: f"client_id = a-12345 account_id = b-12345 {weak} {weak[::-1]}",
        6: "client_id = svc-44821 " + "y" * 372 + f" {weak} and 0123456789abcdef",
        7: "client_id = svc-44821 " + "y" * 390 + f" {weak}",
    }
    table = spark.createDataFrame([*texts.items(), (8, None), (2, texts[2])], "doc_id long, text string").withColumn("kind", F.lit("x"))
    linked = collections.Counter((r.doc_id, r.secret.kind, len(r.ids), len(r.endpoints)) for r in secrets.credentials(table).collect())
    expected = {(2, "weak_secret", 1, 2): 2, (5, "weak_secret", 2, 0): 2, (6, "weak_secret", 1, 0): 1}
    assert linked == expected
    found = collections.Counter((r.doc_id, tuple(s["kind"] for s in r.spans)) for r in secrets.scan(table).collect())
    assert found[2, ("weak_id", "weak_secret", "endpoint", "endpoint")] == 2
    assert {k for k in found if k[0] in (1, 3, 4, 7, 8)} == {(k, ()) for k in (1, 3, 4, 7, 8)}
    for r in secrets.scan(table).where("doc_id = 5").collect():
        assert [s["kind"] for s in r.spans] == ["weak_id", "weak_id", "weak_secret", "weak_secret"]
        assert texts[5][r.spans[2]["start"] : r.spans[2]["end"]] == weak
    assert secrets.credentials(table.where("false")).count() == 0


@pytest.mark.parametrize("text", ["a@b.c@d.e", "@b.c@d.e x", "a@b.c-d@e.f", "1.2.3.4.5.6.7.8", "000.00300.1.2", "9" * 400 + ".1.1.1", "a" * 3000 + "@x", "+1 5 5 5 (5) 5 5 5 5 5 5-"])
def test_plain_personal_data_edge_cases(text):
    assert pii.plain_spans(text) == sorted(personal_spans(text))


def test_contexts_find_unseen_identifiers(spark):
    seeds = [(k, f"please contact staff{k}@mail{k}.example.com now, ref code {k}") for k in range(5)]
    rows = [*seeds, (50, "please contact staff77@mail78.internal now"), (51, "contact nobody99 about it"), (52, "see chapter12a for more")]
    seeds_by_phone = [(60 + k, f"call +1 (555) 555-{1000 + k} today") for k in range(4)]
    table = spark.createDataFrame([*rows, *seeds_by_phone, (70, "call +1555555123 today, call 555x123 never")], "doc_id long, text string")
    found = {r.doc_id: [s["kind"] for s in r.spans] for r in pii.find(table).collect()}
    assert found[51] == found[52] == []
    assert all(found[k] == ["email"] for k in range(5))
    edges = spark.createDataFrame([("call 0", i, 1, 1) for i in range(4)] + [("call 0", 99, 1, 0), ("see a0", 99, 1, 0), ("see a0", 98, 1, 0)], "pattern string, instance long, n long, seed int")
    scores = {r.pattern: r.confidence for r in pii.score_patterns(edges).collect()}
    assert scores["call 0"] > 0.9 and scores["see a0"] < 0.5


def test_context_spans_are_added(spark):
    table = spark.createDataFrame([(k, f"kontakt ab{k}@x{k}.de bitte") for k in range(6)] + [(9, "kontakt ab7@x7.de bitte und kontakt ab8@x8-de bitte")], "doc_id long, text string")
    found = {r.doc_id: [(s["kind"], s["start"], s["end"]) for s in r.spans] for r in pii.find(table).collect()}
    assert found[9][0][0] == "email"


def test_unseen_identifiers_are_found(spark):
    rng = random.Random(8)
    seeds = [f"if lost please phone +1 (555) 555-{1000 + 7 * k} now" for k in range(12)] + [f"for help write to user{k}@mail.example.com today" for k in range(12)]
    noise = [f"in the years {1900 + k}-{1950 + k} the well-{chr(97 + k % 26)}{chr(97 + k // 26)} town {'x' * 200}{k} had 12345{k} people" for k in range(30)]
    planted = {
        "Sie: please phone 555-0142 now": ["555-0142"],
        "do please phone 020 7946 0011 now, or not": ["020 7946 0011"],
        "or write to jane_at_home today": ["jane_at_home"],
        "phone 555-0142 is what stood there": ["555-0142"],  # known from its other place
        "please see file-0142 now": [],
        "the phone well-ca now": [],
        "please phone 4111 1111 1111 1112 now": [],  # the form of a card, but not one
        "": [],
    }
    texts = [*seeds, *noise, *planted]
    rng.shuffle(texts)
    table = spark.createDataFrame([*enumerate(texts), (None, texts[0]), (900, None)], "doc_id long, text string")
    found = pii.find(table).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        if r.doc_id is not None and r.doc_id < 900:
            text = texts[r.doc_id]
            assert [text[s["start"] : s["end"]] for s in r.spans if s["kind"] == "context"] == planted.get(text, []), text
    counts = {r.doc_id: (r.n_context, r.n_phone) for r in pii.digests(pii.find(table)).collect()}
    assert counts[texts.index("Sie: please phone 555-0142 now")] == (1, 0) and counts[texts.index(seeds[0])] == (0, 1)


def test_scores_equal_plain_ones(spark):
    rng = random.Random(9)
    edges = {(f"p{rng.randrange(12)}", i): 1.0 for i in range(60) for _ in range(3)} | {(f"shape {i % 4}", i): 0.5 for i in range(60)}
    seeds = {i for i in range(60) if rng.random() < 0.6}
    scores = {i: float(i in seeds) for i in range(60)}
    for _ in range(pii.ROUNDS):
        new = {}
        for i in range(60):
            said, weights, vouched = 0.0, 0.0, 0
            for (p, own), weight in edges.items():
                others = [scores[j] for q, j in edges if q == p and j != i]
                if own == i and len(others) >= pii.MIN_SEEDS:
                    sure = sum(others) / len(others) if sum(o >= 0.5 for o in others) >= pii.MIN_SEEDS else 0.0
                    said, weights, vouched = said + weight * sure, weights + weight, vouched + (weight == 1 and sure >= 0.5)
            new[i] = 1.0 if i in seeds else said / weights if vouched else 0.0
        scores = new
    table = spark.createDataFrame([(p, i, int(i in seeds), w) for (p, i), w in edges.items()], "pattern string, instance long, seed int, weight double")
    found = {r.instance: r.score for r in pii.score_instances(table).collect()}
    assert found.keys() == scores.keys() and all(abs(found[i] - scores[i]) < 1e-9 for i in found)


def test_words_around():
    text = "y" * 500 + " One, (two) x12345: " + "z" * 300 + " end"
    at = text.index("x12345")
    assert pii.around(text, at, at + 6) == ("one", "two", "z" * 300)
    assert pii.around(text, 0, 500) == ("", "", "one") and pii.around("abc", 0, 3) == ("", "", "")
    assert pii.around(text, len(text) - 3, len(text)) == ("x12345", "z" * 300, "")
    assert len(set(pii.features(text, at, at + 6))) == 4 and all(len(f) <= 100 for f in pii.features(text, 0, 500))


def test_redaction(docs):
    found = {r.doc_id: (r.text, r.n_chars) for r in pii.redacted_documents(docs).collect()}
    assert found[12][0] == "mail [email] from [ip] or [phone], card [card], bad 300.1.1.1"
    assert found[4][0] is None and found[5][0] == ""
    assert pii.redacted_documents(docs).columns == docs.columns


def base_counts(text):
    words = WORD.findall(text)
    runs = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines, doubled = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            doubled += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubled, len(covered)


@pytest.mark.parametrize("table", ["docs", "sample", "no_docs"])
def test_quality_counts(request, table):
    docs = request.getfixturevalue(table)
    found = quality.judged(docs).collect()
    plain = collections.Counter((r.doc_id, *base_counts(r.text or "")) for r in docs.collect())
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == plain
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in found)
    assert not any(r.kept for r in found if r.base_failed)


def test_perplexity_bands_reject_junk_only(spark):
    import random

    draw = random.Random(5)
    words = ["".join(draw.choice(["the", "on", "er", "ing", "sha", "li"]) for _ in range(draw.randrange(1, 4))) for _ in range(300)]
    clean = [(k, " ".join(draw.choice(words) for _ in range(150)), "en") for k in range(120)]
    junk = [(1000 + k, " ".join("".join(draw.choice("qxzjvkw#%$") for _ in range(7)) for _ in range(150)), "en") for k in range(3)]
    found = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")).collect()}
    assert not any(found[1000 + k] for k in range(3))
    assert sum(found[k] for k in range(120)) >= 119


def test_a_group_of_copies_weighs_as_one_document(spark):
    """80 % of a language's rows are one text; the other clean documents stay, and the band is that of the different texts."""
    import random

    draw = random.Random(6)
    parts = [["the", "on", "er", "ing", "sha", "li"], ["mu", "vor", "pla", "st", "ek", "ow"]]
    vocabularies = [["".join(draw.choice(p) for _ in range(draw.randrange(1, 4))) for _ in range(300)] for p in parts]
    clean = [(k, " ".join(draw.choice(vocabularies[0]) for _ in range(120)), "en") for k in range(100)]
    copied = " ".join(draw.choice(vocabularies[1]) for _ in range(120))
    copies = [(1000 + k, copied, "en") for k in range(400)]
    judged = lambda rows: {r.doc_id: (r.kept, r.log_perplexity) for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    found, single = judged(clean + copies), judged(clean + copies[:1])
    assert sum(found[k][0] for k in range(100)) >= 99
    assert all(found[k][0] == single[k][0] and abs(found[k][1] - single[k][1]) < 1e-6 for k in single)


def test_model_is_a_distribution(sample):
    """Probabilities of all classes after a context, seen or not, sum to one."""
    import numpy as np

    model, classes = quality.train(sample.where("lang = 'en'"))
    own = quality._collected(model, classes, ["en"])["en"]
    every = np.arange(1 << quality.CLASS_BITS, dtype=np.uint64)
    for context in (0, 5 | (3 << 6), 62 | (17 << 6) | (9 << 12), 2 | (2 << 6) | (2 << 12)):
        total = np.exp(own.log_probability((np.uint64(context) << np.uint64(quality.CLASS_BITS)) | every)).sum()
        assert abs(total - 1) < 2e-3


@pytest.mark.parametrize("groups", [3, 5, 6, 11, 500])
def test_numbers_of_any_number_of_words_are_candidates(groups):
    """A number is one candidate however many words it is in, and no word of it is left out."""
    number = " ".join(str(10 + k % 90) for k in range(groups))
    assert list(pii.other_spans(f"quote {number} please", [])) == [(6, 6 + len(number))]


@pytest.mark.parametrize("first", [0x4E00, 0x20000])
def test_characters_beyond_the_most_frequent_tell_texts_apart(spark, first):
    """Languages of thousands of characters, those beyond 16 bits too: texts of words the model knows stay, texts of as rare characters in no order go."""
    import random

    draw = random.Random(8)
    words = ["".join(chr(first + draw.randrange(2000)) for _ in range(3)) for _ in range(300)]
    clean = [(k, " ".join(draw.choice(words) for _ in range(150)), "zh") for k in range(120)]
    junk = [(1000 + k, " ".join("".join(chr(first + draw.randrange(2000)) for _ in range(3)) for _ in range(150)), "zh") for k in range(3)]
    found = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")).collect()}
    assert not any(found[1000 + k] for k in range(3))
    assert sum(found[k] for k in range(120)) >= 119



def test_pipeline_tells_texts_of_rare_characters_apart(spark):
    import random

    import corpus_pipeline

    draw = random.Random(10)
    words = ["".join(chr(0x4E00 + draw.randrange(2000)) for _ in range(3)) for _ in range(300)]
    clean = [(k, " ".join(draw.choice(words) for _ in range(150)), "zh", "web") for k in range(120)]
    junk = [(1000 + k, " ".join("".join(chr(0x4E00 + draw.randrange(2000)) for _ in range(3)) for _ in range(150)), "zh", "web") for k in range(3)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, "").collect()}
    assert len(kept) >= 119 and not kept & {1000, 1001, 1002}

def test_spelled_texts_keep_every_character(spark):
    """Symbols lead back to the text, and training counts the n-grams of symbols that scoring looks up."""
    import random

    import numpy as np

    draw = random.Random(9)
    letters = [chr(c) for c in (*range(0x61, 0x7B), *range(0x430, 0x450), *range(0x3B1, 0x3C2), 0x1F600, 0x4E00, 0xFFFD)]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(1, 80))) for _ in range(40)]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    model, classes = quality.train(docs)
    own = quality._collected(model, classes, ["x"])["x"]
    unit_of = {int(own.symbols[u]): u for u in range(1 << 16) if own.lengths[u] == 1 and u}
    assert len(unit_of) == quality.CLASSES
    contexts: dict[int, set[int]] = {}
    for text in texts:
        symbols, ends = own.spelled(quality._points([text]))
        symbols, units, at = symbols.tolist(), [], quality.ORDER - 1
        while at < len(symbols):
            if symbols[at] < quality.DIGIT:
                units.append(unit_of[symbols[at]])
                at += 1
            else:
                units.append(int("".join(f"{d - quality.DIGIT:x}" for d in symbols[at : at + 4]), 16))
                at += 4
        assert np.array(units, "<u2").tobytes().decode("utf-16-le") == text and ends[-1] == len(symbols)
        for i in range(quality.ORDER - 1, len(symbols)):
            a, b, c, d = symbols[i - 3 : i + 1]
            contexts.setdefault((a << 12) | (b << 6) | c, set()).add(d)
    known = {int(r.gram) for r in model.where("kind = 'p' and n = 4").collect()}
    assert known == {(context << 6) | last for context, lasts in contexts.items() for last in lasts}
    assert len(set(own.scores(["\U0001f600 一", "\U0001f601 一", "\U0001f600 丁"]).tolist())) == 3


def test_languages(spark, sample, docs, no_docs):
    held = 0
    right = 0
    found = {r.doc_id: r for r in langid.identify(sample).collect()}
    for r in sample.collect():
        out = zlib.crc32(str(r.doc_id).encode()) % 4 == 2
        assert found[r.doc_id].held_out == out
        if out and r.lang and r.text and langid.LETTER.search(r.text):
            held += 1
            right += found[r.doc_id].lang_pred == r.lang
    assert held > 30 and right >= 0.97 * held
    edge = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert len(langid.identify(docs).collect()) == docs.count()
    assert edge[4].lang_pred == edge[5].lang_pred == edge[6].lang_pred == "und" and edge[4].score == 0
    assert all(0 <= r.score <= 1 for r in edge.values())
    assert langid.identify(no_docs).collect() == []


def test_switched_text_has_both_languages():
    import numpy as np

    rng = np.random.default_rng(0)
    make = lambda parts: " ".join("".join(rng.choice(parts, 3)) for _ in range(200))
    model = langid.fit([("x", make(["ka", "ko", "ki"])) for _ in range(5)] + [("y", make(["lu", "le", "la"])) for _ in range(5)], sequences=400)
    words = ["kakoki"] * 6 + ["lulela"] * 6
    rows = model.emissions(words, {})
    sums = langid.posterior_sums(model, rows, np.array([12]), np.ones(12, bool))
    assert abs(sums[0, 0] - 6) < 0.5 and abs(sums[0, 1] - 6) < 0.5
    assert model.transitions[0, 0] > model.transitions[0, 1]


@pytest.mark.parametrize(("first", "second"), [("kakoki", "lulela"), ("天地玄黄宇宙", "日月盈昃辰宿"), ("กาขาคาง", "ຈາຊາຍາດ")])
def test_every_part_of_a_text_without_spaces_counts(spark, first, second):
    import random

    draw = random.Random(4)
    make = lambda signs, n: "".join(draw.choice(signs) for _ in range(n))
    gap = " " if first.isascii() else ""
    model = langid.fit([(lang, gap.join(make(signs, 6) for _ in range(100))) for lang, signs in (("x", first), ("y", second)) for _ in range(5)], sequences=400)
    texts = {1: make(first, 45) + make(second, 400), 2: make(second, 45) + make(first, 400), 3: make(first, 200)}
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), model).collect()}
    assert {k: lang for k, (lang, _) in found.items()} == {1: "y", 2: "x", 3: "x"}
    assert 0.8 < found[1][1] < 0.97


def test_words_hold_all_characters():
    assert langid.words_of("Ein Satz\u00a0mit Wörtern") == ["ein", "satz", "mit", "wörtern"]
    for text in ("x" * 100 + " y", "日本語のテキスト abc 中文", "ภาษาไทยที่มีสระ", "か\u3099" + "\u3099" * 90, "a\u3099b"):
        words = langid.words_of(text)
        assert "".join(words) == "".join(text.lower().split()) and max(map(len, words)) <= langid.LONGEST


@pytest.mark.parametrize("table", ["docs", "sample", "no_docs"])
def test_mix(request, table):
    docs = request.getfixturevalue(table)
    found = mixing.mix(docs).collect()
    rows = docs.collect()
    size = lambda r: len(WORD.findall(r.text or ""))
    totals = collections.Counter()
    for r in rows:
        totals[r.source] += size(r)
    order = sorted([s for s in totals if s is not None]) + [s for s in totals if s is None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    capped, total = set(), 1.5 * sum(totals.values())
    while True:
        rest = total - sum(2 * totals[s] for s in capped)
        weights = sum(weight[s] for s in order if s not in capped)
        over = {s for s in order if s not in capped and rest * weight[s] / weights > 2 * totals[s]}
        if not over:
            break
        capped |= over
    target = {s: 2 * totals[s] if s in capped else rest * weight[s] / weights for s in order}
    sources = {r.doc_id: r.source for r in rows if r.doc_id is not None}
    assert collections.Counter((r.doc_id, r.size) for r in found) == collections.Counter((r.doc_id, size(r)) for r in rows)
    assert all(r.taken in (0, r.size, 2 * r.size) for r in found)
    taken, largest = collections.Counter(), collections.Counter()
    for r in found:
        source = sources.get(r.doc_id, "c")
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
        assert abs(r.target - target[source]) < 1e-6 * max(1, target[source]) and r.source_size == totals[source]
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in order)
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    expanded = collections.Counter(r.doc_id for r in mixing.mixed_documents(docs).collect())
    wanted = collections.Counter()
    for r in found:
        wanted[r.doc_id] += r.taken // r.size if r.size else 0
    assert expanded == +wanted
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_mix_of_many_documents_in_narrowed_ranges(spark, monkeypatch):
    text = F.concat(F.lit("one two three"), F.when(F.col("id") % 5 > 0, F.lit(" ####")).otherwise(""))
    source = F.when(F.col("id") % 3 > 0, F.lit("a")).when(F.col("id") % 2 > 0, F.lit("b"))
    docs = spark.range(3000).select(F.least("id", F.lit(2500)).alias("doc_id"), text.alias("text"), source.alias("source"))
    whole = sorted(map(str, mixing.mix(docs).collect()))
    a = mixing.mix(docs).where("doc_id < 2500 and doc_id % 3 > 0").agg(F.sum("taken").alias("t"), F.max("target").alias("g")).first()
    # the repeated document is taken or left as one
    assert a.g - 2 * 4 * 500 <= a.t <= a.g + 4
    monkeypatch.setattr(mixing, "DOCS_PER_RANGE", 3)
    monkeypatch.setattr(mixing, "SLOTS", 7)
    assert sorted(map(str, mixing.mix(docs).collect())) == whole


def test_languages_of_long_texts_train(spark):
    long = [(2 * k + 1, "fr", "le chat dort sur la table et il mange du pain avec nous " * 720) for k in range(40)]
    short = [(2 * k, "en", "the cat sleeps on the table and it eats some bread with us " * 3) for k in range(40)]
    copies = [(1000 + k, "de", "die katze liegt auf dem tisch " * 5) for k in range(400)] + [(2000 + k, "de", f"der hund {k} frisst das brot mit uns im garten {k}") for k in range(60)]
    table = spark.createDataFrame([*long, *short, *copies], "doc_id long, lang string, text string")
    sample = langid.training_sample(table)
    counts = collections.Counter(lang for lang, _ in sample)
    assert counts["fr"] == 1 and counts["de"] > 30 and max(len(t) for _, t in sample) == 30_000
    found = {r.doc_id: r.lang_pred for r in langid.identify(table).collect()}
    assert all(found[k] == lang for k, lang, _ in [*long, *short])
