"""Personal data: plain patterns, and identifiers that their contexts give away.

The plain patterns' matches are the seeds. Identifiers stand in lexical patterns: the word before, the two words before, the word before with
the word after; their shape (digits as 0, letters as a or A, runs as one) is a feature beside these. Features and instances are a graph.
A feature is as good as the share of its other instances known to be personal, an instance as the mean of its features says;
Spark scores the graph in rounds. Instances that two lexical patterns or more vouch for are reported wherever they stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.durable import cut_lineage

# Kinds in the order in which spans of one start are listed, and their patterns.
KINDS = ["email", "ip", "card", "phone"]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# digit runs are taken whole, so no text makes a search go back over them
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# an identifier that no plain pattern need know: numbers in several words, or a word with a digit or an inner sign
NUMBERS = re.compile(r"(?<![^\x20\x09-\x0D])[+(]?[0-9][0-9().-]*+(?:\x20[0-9(][0-9().-]*+)+(?![^\x20\x09-\x0D])")
CANDIDATE = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@_./:#=+-]*+[0-9@_./:#=+-][^\x20\x09-\x0D]*+")
FORM = re.compile(r"[0-9]|[^\W_][@_./:#=+-][^\W_]")
# numbers of a plain kind's form which failed its test are not candidates; a card is in five words at most
FAILED = re.compile(r"[0-9](?:[\x20-]?[0-9]){13,}|[0-9]+(?:\.[0-9]+){3}")
EDGE = ".,;:!?()[]{}<>\"'"

LEAST_CHARS = 6
MIN_SEEDS, MIN_CONFIDENCE, MIN_PATTERNS, ROUNDS = 3, 0.7, 2, 3
SHAPE_WEIGHT = 0.5


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping e-mail addresses: each ``@`` with a domain, and all local characters since the last one before it."""
    found, last = [], 0
    for match in AT_DOMAIN.finditer(text):
        at = start = match.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            found.append((start, match.end()))
            last = match.end()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def plain_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, order, kind, end) of the plain kinds' matches, sorted."""
    spans = [(a, 0, "email", b) for a, b in emails(text)] if "@" in text else []
    if DIGITS.search(text):
        for m in IP.finditer(text):
            if all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in m.groups()):
                spans.append((m.start(), 1, "ip", m.end()))
        for m in CARD.finditer(text):
            if 14 <= m.end() - m.start() and 14 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
                spans.append((m.start(), 2, "card", m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(DIGITS.findall(m[0])) <= 15:
                    spans.append((m.start(), 3, "phone", m.end()))
    return sorted(spans)


def shape(word: str) -> str:
    """Digits as 0, letters as a or A, other characters as they are; runs of one sign as one."""
    signs = re.sub(r"[0-9]+", "0", word)
    return re.sub(r"[^\W\d_A-Z]+", "a", re.sub(r"[A-Z]+", "A", signs))


def _word(word: str) -> str:
    return word.strip(EDGE).lower()


def around(text: str, start: int, end: int) -> tuple[str, str, str]:
    """The two words before ``start`` and the one after ``end``, whole, lower-cased, without outer punctuation; empty at a text's ends."""
    window = 64
    # with a third word before them the last two are whole
    while len(before := text[max(0, start - window) : start].split()) < 3 and window < start:
        window *= 4
    window = 32
    while len(after := text[end : end + window].split(None, 2)) < 3 and end + window < len(text):
        window *= 4
    # what is left of the identifier's own word is not the next one
    if after and end < len(text) and not text[end].isspace():
        after = after[1:]
    before = ["", "", *before]
    return _word(before[-2]), _word(before[-1]), _word(after[0]) if after else ""


def features(text: str, start: int, end: int) -> list[str]:
    """Names of the lexical patterns that an identifier stands in, and last of its shape; long names as their digests."""
    earlier, word, later = around(text, start, end)
    names = [f"l:{word} _", f"l:{earlier} {word} _", f"l:{word} _ {later}", f"s:{shape(text[start:end])}"]
    return [n if len(n) <= 100 else f"{n[:2]}#{xxhash.xxh3_128_hexdigest(n)}" for n in names]


def other_spans(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Spans of candidates outside ``taken`` (sorted spans): first numbers in several words, then single words."""
    if not FORM.search(text):
        return

    def free(spans: list[tuple[int, int]], used: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        at, last = 0, 0
        for a, b in spans:
            while at < len(used) and used[at][0] < b:
                last = max(last, used[at][1])
                at += 1
            if last <= a:
                yield a, b

    several = [m.span() for m in NUMBERS.finditer(text) if sum(map(str.isdigit, m[0])) >= LEAST_CHARS] if DIGITS.search(text) else []
    several = list(free(several, taken))
    words = []
    for m in CANDIDATE.finditer(text):
        word = m[0]
        a, b = m.start() + len(word) - len(word.lstrip(EDGE)), m.start() + len(word.rstrip(EDGE))
        if b - a >= LEAST_CHARS and FORM.search(text, a, b):
            words.append((a, b))
    for a, b in [*several, *free(words, sorted([*taken, *several]))]:
        if text.count(" ", a, b) > 4 or not FAILED.fullmatch(text, a, b):
            yield a, b


def candidates(text: str, spans: list[tuple[int, int, str, int]]) -> list[tuple[list[str], int, int, int, bool]]:
    """(features, instance, start, end, seed) of a text's identifiers: the plain matches, and what else may be one."""
    taken = sorted((a, b) for a, _, _, b in spans)
    found = [(a, b, True) for a, b in taken] + [(a, b, False) for a, b in other_spans(text, taken)]
    return [(features(text, a, b), xxhash.xxh3_64_intdigest(text[a:b]) >> 1, a, b, seed) for a, b, seed in found]


FOUND = (
    "row long, doc_id long, tie long, spans array<struct<start:int,order:int,kind:string,end:int>>, "
    "items array<struct<features:array<string>,instance:long,start:int,end:int,seed:boolean>>"
)
SPAN_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("order", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
ITEM_ARROW = pa.list_(
    pa.struct([("features", pa.list_(pa.string())), ("instance", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_())])
)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for first in range(0, whole.num_rows, 1000):
            batch = whole.slice(first, 1000)
            spans, items = [], []
            for text in batch.column(3).to_pylist():
                text = text or ""
                mine = plain_spans(text)
                spans.append([dict(zip(("start", "order", "kind", "end"), s, strict=True)) for s in mine])
                items.append([dict(zip(("features", "instance", "start", "end", "seed"), c, strict=True)) for c in candidates(text, mine)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(spans, SPAN_ARROW), pa.array(items, ITEM_ARROW)], ["row", "doc_id", "tie", "spans", "items"]
            )


def _judged(edges: DataFrame, scores: DataFrame, min_seeds: int) -> tuple[DataFrame, DataFrame]:
    """Confidences of patterns by the scores of their instances, and the new scores of instances by their patterns."""
    known = F.col("score") >= 0.5
    sums = [F.sum("score").alias("s"), F.count(F.lit(1)).alias("n"), F.sum(known.cast("int")).alias("known")]
    patterns = cut_lineage(edges.join(scores.select("instance", "score"), "instance").groupBy("pattern").agg(*sums), "patterns")
    # what an instance itself adds to a pattern does not speak for it
    met = edges.join(patterns, "pattern").join(scores.select("instance", "score"), "instance")
    others = F.col("known") - known.cast("int")
    sure = F.when(others >= min_seeds, (F.col("s") - F.col("score")) / (F.col("n") - 1)).otherwise(0.0)
    met = met.where(F.col("n") > min_seeds).withColumn("sure", sure)
    lexical = F.col("weight") == 1
    judged = met.groupBy("instance").agg(
        (F.sum(F.col("sure") * F.col("weight")) / F.sum("weight")).alias("mean"),
        F.count_if(lexical & (F.col("sure") >= 0.5)).alias("vouched"),
    )
    seeds = edges.groupBy("instance").agg(F.max("seed").alias("seed"))
    vouched = F.coalesce("vouched", F.lit(0))
    score = F.when(F.col("seed") == 1, 1.0).when(vouched > 0, F.col("mean")).otherwise(0.0)
    new = seeds.join(judged, "instance", "left").select("instance", "seed", score.alias("score"), vouched.alias("vouched"))
    return patterns, cut_lineage(new, "instances")


def _scored(edges: DataFrame, rounds: int, min_seeds: int) -> tuple[DataFrame, DataFrame]:
    if "weight" not in edges.columns:
        edges = edges.withColumn("weight", F.lit(1.0))
    edges = edges.select("pattern", "instance", "seed", "weight")
    scores = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("score"))
    patterns = None
    for _ in range(rounds):
        patterns, scores = _judged(edges, scores, min_seeds)
    return patterns, scores


def score_patterns(edges: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """``pattern``, ``confidence`` and ``known`` of the graph ``edges`` (pattern, instance, seed: 1 if the instance is a plain match; weight).

    A pattern's confidence is the mean score of its different instances, but 0 while fewer than ``min_seeds`` of them score 0.5 or more.
    """
    patterns, _ = _scored(edges, rounds, min_seeds)
    return patterns.select("pattern", F.when(F.col("known") >= min_seeds, F.col("s") / F.col("n")).otherwise(0.0).alias("confidence"), "known")


def score_instances(edges: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """``instance``, ``seed``, ``score`` and ``vouched`` of the same graph.

    A seed scores 1. Another instance has the mean confidence of its patterns, each without the instance itself and by its ``weight``;
    patterns of ``min_seeds`` other instances or fewer say nothing, and without a lexical one (weight 1) of 0.5 or more the score is 0.
    ``vouched`` is the number of these. A round is two aggregates and joins with one row per pattern and instance.
    """
    return _scored(edges, rounds, min_seeds)[1]


def _spans(docs: DataFrame, min_confidence: float) -> DataFrame:
    """Per row of ``docs``: row, doc_id, tie and all spans."""
    chosen = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.xxhash64("text").alias("tie"), F.col("text").cast("string"))
    found = cut_lineage(chosen.mapInArrow(_extract, FOUND), "identifiers")
    items = found.select("row", F.explode("items").alias("i")).select("row", "i.*")
    edges = items.select("instance", "seed", F.explode("features").alias("pattern")).groupBy("pattern", "instance").agg(F.max(F.col("seed").cast("int")).alias("seed"))
    weight = F.when(F.col("pattern").startswith("s:"), SHAPE_WEIGHT).otherwise(1.0)
    edges = cut_lineage(edges.withColumn("weight", weight), "edges")
    good = score_instances(edges).where((F.col("seed") == 0) & (F.col("score") >= min_confidence) & (F.col("vouched") >= MIN_PATTERNS))
    span = F.struct("start", F.lit(len(KINDS)).alias("order"), F.lit("context").alias("kind"), "end")
    added = items.where("not seed").join(good.select("instance"), "instance").groupBy("row").agg(F.collect_list(span).alias("added"))
    both = found.join(added, "row", "left")
    none = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")
    return both.select("row", "doc_id", "tie", F.sort_array(F.concat("spans", F.coalesce("added", none))).alias("spans"))


def find(docs: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Per row of ``docs``: ``doc_id`` and ``spans``, an array of (start, order, kind, end), sorted; positions count code points.

    Kinds are the plain ones and ``context``: numbers in two or more words, or a word with a digit or an inner sign, at least ``LEAST_CHARS``
    characters long, whose instance ``score_instances`` gives ``min_confidence`` and ``MIN_PATTERNS`` lexical patterns that vouch for it.
    Copies of a text add nothing, as instances of a pattern count once. A null or empty text has no spans; without seeds there are
    no context spans. Rows, repeated ones and those with a null doc_id too, all stay; other columns are ignored.
    """
    return _spans(docs, min_confidence).select("doc_id", "spans")


def digests(found: DataFrame) -> DataFrame:
    """Counts per kind, the SHA-256 of plain spans, and all spans as a string."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    plain = F.filter("spans", lambda s: s["order"] < len(KINDS))
    counts = [F.size(F.array_remove(F.transform("spans", lambda s: F.when(s["kind"] == kind, 1).otherwise(0)), 0)).cast("long").alias(f"n_{kind}") for kind in [*KINDS, "context"]]
    return found.select("doc_id", *counts, F.sha2(joined(plain), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(text: str, spans: list[dict]) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans are one, of the kind that starts first."""
    parts, last = [], 0
    for span in spans:
        if span["start"] >= last:
            parts += [text[last : span["start"]], f"[{span['kind']}]"]
            last = span["end"]
        elif span["end"] > last:
            last = span["end"]
    return "".join([*parts, text[last:]])


def redacted_documents(docs: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rows of ``docs``, all columns, with each span of ``find`` in ``text`` replaced by its kind, and ``n_chars``, if there is one, counted anew."""
    spans = _spans(docs, min_confidence).where(F.size("spans") > 0).groupBy("doc_id", "tie").agg(F.first("spans").alias("__spans"))
    spans = spans.select(F.col("doc_id").alias("__doc"), F.col("tie").alias("__doc_tie"), "__spans")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")) & (F.col("__tie") == F.col("__doc_tie"))
    joined = docs.withColumn("__tie", F.xxhash64(F.col("text").cast("string"))).join(spans, same, "left")

    @F.pandas_udf("string")
    def replaced(texts, found):
        return texts.combine(found, lambda t, s: t if s is None or t is None else redact(t, [x if isinstance(x, dict) else x.asDict() for x in s]))

    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(replaced("text", "__spans"))
    out = joined.withColumn("__text", text)
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("__text").alias("text"))
        elif name == "n_chars":
            columns.append(F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.length("__text")).cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        else:
            columns.append(F.col(f"`{name}`"))
    return out.select(*columns)
