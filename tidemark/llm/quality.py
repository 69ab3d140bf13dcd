"""Quality rules: counts over a text, then perplexity bands of a modified Kneser-Ney model per language.

The model is of character n-grams, so it has no unknown words and its tables stay small. Tasks count the n-grams of whole texts, Spark adds
the counts up, and the discounts, continuation counts, probabilities and back-off weights are joins and aggregates. A language's model is
a few arrays sorted by a hash of the n-gram. Its symbols are 6 bits wide, so an order's table has a proven bound (64 ** 4 entries), and yet no
character is left out or taken for another: the ``CLASSES`` most frequent UTF-16 units of a language are a symbol each, all others are
spelled as four hexadecimal digits, which are symbols of their own. Languages are scored in groups whose models together stay below
``MODEL_BYTES``, or alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import release, slices
from tidemark.plans.durable import cut_lineage

ORDER = 4
CLASS_BITS = 6
DIGIT = (1 << CLASS_BITS) - 16  # the symbol of digit 0; the last 16 symbols are digits
DIGITS = 4  # of a unit of 16 bits that is spelled
CLASSES = DIGIT - 1  # symbol 0 is the margin before a text
GRAM = (1 << (CLASS_BITS * ORDER)) - 1
MODEL_BYTES = 192_000_000
BIN = 0.005  # of log perplexity, for the quantiles
MIX = np.uint64(0x9E3779B97F4A7C15)

SYMBOLS = "#*$%&|<>"
WORD_SPACE = "\t\n\x0b\x0c\r "


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside runs of ``width`` words that occur twice or more, the first occurrence included."""
    if len(words) <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
    last = len(ids) - width + 1
    if len(number) < 1 << 21:
        # three numbers below 2 ** 21 fit in one, so equal runs are equal values
        runs = np.zeros(last, np.uint64)
        for k in range(width):
            runs = (runs << np.uint64(21)) | ids[k : k + last]
    else:
        runs = np.unique(np.stack([ids[k : k + last] for k in range(width)], 1), axis=0, return_inverse=True)[1].reshape(-1)
    order = np.argsort(runs, kind="stable")
    same = runs[order][1:] == runs[order][:-1]
    twice = np.zeros(last, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for k in range(width):
        covered[k : k + last] |= twice
    return int(covered.sum())


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    text = text or ""
    # bytes are split at space and U+0009 to U+000D only, text would be at other white space too
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, WORD_SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines, doubled = set(), 0
    if "\n" in text:
        for line in text.split("\n"):
            if line.strip(WORD_SPACE):
                doubled += line in lines
                lines.add(line)
    return len(words), chars, symbols, doubled, repeated_words(words)


def _points(texts: list[str]) -> np.ndarray:
    """UTF-16 units of lower-cased texts, each after a margin of zeros."""
    joined = ("\0" * (ORDER - 1)) + ("\0" * (ORDER - 1)).join(texts)
    return np.frombuffer(joined.lower().encode("utf-16-le"), "<u2")


def _by_lang(langs: list, texts: list) -> Iterator[tuple[str, list[int]]]:
    """Places of non-empty texts by language, in groups of a bounded length."""
    groups: dict[str, list[int]] = {}
    chars: dict[str, int] = {}
    for place, (lang, text) in enumerate(zip(langs, texts, strict=True)):
        if text:
            lang = lang or ""
            groups.setdefault(lang, []).append(place)
            chars[lang] = chars.get(lang, 0) + len(text)
            if chars[lang] > 1_000_000:
                yield lang, groups.pop(lang)
                chars[lang] = 0
    yield from groups.items()


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the n-grams of a task's texts, added up as far as fits."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in parts])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[first], np.add.reduceat(np.concatenate([n for _, n in parts])[order], first)

    def rows(lang: str) -> pa.RecordBatch:
        keys, number = merged(held.pop(lang))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(number)], ["lang", "gram", "n"])

    parts = (pair for batch in batches for pair in zip(slices(batch.column(0)), slices(batch.column(1)), strict=True))
    for langs, texts in parts:
        for lang, places in _by_lang(langs, texts):
            points = _points([texts[p] for p in places]).astype(np.uint64)
            grams = points[ORDER - 1 :].copy()
            for k in range(1, ORDER):
                grams |= points[ORDER - 1 - k : len(points) - k] << np.uint64(16 * k)
            grams = np.sort(grams[points[ORDER - 1 :] != 0])
            if not len(grams):
                continue
            first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
            held.setdefault(lang, []).append((grams[first], np.diff(np.append(first, len(grams)))))
            if sum(len(k) for k, _ in held[lang]) > 1_000_000:
                held[lang] = [merged(held[lang])]
                if len(held[lang][0][0]) > 500_000:
                    yield rows(lang)
    for lang in list(held):
        yield rows(lang)
    release()


def _point(gram: Column, back: int) -> Column:
    """The UTF-16 unit ``back`` places before the last of a packed n-gram."""
    return F.shiftrightunsigned(gram, 16 * back).bitwiseAND(0xFFFF)


def _spelled(point: Column, digits: int = DIGITS) -> Column:
    """The first ``digits`` symbols of a spelled unit, packed."""
    packed = F.lit(0).cast("long")
    for k in range(digits):
        digit = F.shiftright(point, 4 * (DIGITS - 1 - k)).bitwiseAND(0xF) + DIGIT
        packed = packed.bitwiseOR(F.shiftleft(digit.cast("long"), CLASS_BITS * (digits - 1 - k)))
    return packed


def _symbol_grams(gram: Column, classes: Column) -> Column:
    """The n-grams of symbols that end in the last unit of a packed n-gram of units: one, or one per digit of a spelled unit."""
    context = F.lit(0).cast("long")
    for back in range(ORDER - 1, -1, -1):
        point = _point(gram, back)
        symbol = F.when(point == 0, 0).otherwise(F.try_element_at(classes, point)).cast("long")
        after = F.shiftleft(context, CLASS_BITS).bitwiseOR(symbol).bitwiseAND(GRAM)
        if back:
            # the digits of a unit are a whole n-gram, so what went before is out of sight
            context = F.when(symbol.isNull(), _spelled(point)).otherwise(after)
    along = [F.shiftleft(context, CLASS_BITS * k).bitwiseOR(_spelled(point, k)).bitwiseAND(GRAM) for k in range(1, DIGITS + 1)]
    return F.when(symbol.isNull(), F.array(*along)).otherwise(F.array(after))


def train(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables of the model: (lang, n, gram, value, kind) with kind ``p`` (log probability) or ``b`` (log back-off weight), and (lang, point, class).

    Texts that are equal within a language count once, however many rows hold them; a task passes on one row of each.
    """
    chosen = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.col("text").cast("string")).where("text <> ''")
    chosen = chosen.groupBy("lang", F.xxhash64("text").alias("tie")).agg(F.first("text").alias("text")).select("lang", "text")
    raw = chosen.mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    raw = cut_lineage(raw, "grams")
    by_use = Window.partitionBy("lang").orderBy(F.desc("n"), "point")
    used = raw.groupBy("lang", _point(F.col("gram"), 0).alias("point")).agg(F.sum("n").alias("n"))
    # at most 2 ** 16 rows per language; units beyond the CLASSES most frequent are spelled
    classes = cut_lineage(used.withColumn("class", F.row_number().over(by_use)).where(F.col("class") <= CLASSES).select("lang", "point", "class"), "classes")
    # written, so that their size is known and the n-grams need not be dealt by language alone
    maps = cut_lineage(classes.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("point", "class"))).alias("classes")), "maps")
    parts = raw.join(maps, "lang")
    symbols = parts.select("lang", F.explode(_symbol_grams(F.col("gram"), F.col("classes"))).alias("gram"), "n")
    top = symbols.groupBy("lang", "gram").agg(F.sum("n").alias("c"))
    tables = {ORDER: cut_lineage(top, "grams-top")}
    for n in range(ORDER - 1, 0, -1):
        # a lower order counts the different characters that precede its n-grams
        tail = F.col("gram").bitwiseAND((1 << (CLASS_BITS * n)) - 1)
        tables[n] = cut_lineage(tables[n + 1].groupBy("lang", tail.alias("gram")).agg(F.count("*").alias("c")), f"grams-{n}")
    model = lower = None
    for n in range(1, ORDER + 1):
        table = tables[n]
        of = table.groupBy("lang").agg(*[F.sum((F.col("c") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)])
        y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))
        steps = [
            F.least(F.greatest(k - (k + 1) * y * F.col(f"n{k + 1}") / F.greatest(F.col(f"n{k}"), F.lit(1.0)), F.lit(0.1 * k)), F.lit(0.9 * k)).alias(f"d{k}")
            for k in (1, 2, 3)
        ]
        table = table.join(cut_lineage(of.select("lang", *steps), f"discounts-{n}"), "lang")
        table = table.withColumn("context", F.shiftrightunsigned("gram", CLASS_BITS)).withColumn("off", F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3")))
        context = table.groupBy("lang", "context").agg(F.sum("c").alias("all"), F.sum("off").alias("freed"))
        joined = table.join(context, ["lang", "context"])
        own = (F.col("c") - F.col("off")) / F.col("all")
        left = F.col("freed") / F.col("all")
        if n == 1:
            probability = own + left / (1 << CLASS_BITS)
            joined = joined.withColumn("p", probability)
        else:
            tail = F.col("gram").bitwiseAND((1 << (CLASS_BITS * (n - 1))) - 1)
            joined = joined.withColumn("tail", tail).join(lower, ["lang", "tail"]).withColumn("p", own + left * F.col("below"))
        found = cut_lineage(joined.select("lang", "gram", "p"), f"model-{n}")
        lower = found.select("lang", F.col("gram").alias("tail"), F.col("p").alias("below"))
        rows = found.select("lang", F.lit(n).alias("n"), "gram", F.log("p").cast("float").alias("value"), F.lit("p").alias("kind"))
        weights = context.select("lang", F.lit(n).alias("n"), F.col("context").alias("gram"), F.log(left).cast("float").alias("value"), F.lit("b").alias("kind"))
        rows = rows.unionByName(weights)
        model = rows if model is None else model.unionByName(rows)
    return cut_lineage(model, "model"), classes


class SortedModel:
    """One language's model: per order and kind the hashes of n-grams, sorted, and their values."""

    def __init__(self, rows: list[tuple[int, str, np.ndarray, np.ndarray]], points: np.ndarray, classes: np.ndarray) -> None:
        self.tables = {}
        for n, kind, grams, values in rows:
            hashes = self.hashed(grams)
            order = np.argsort(hashes)
            self.tables[n, kind] = hashes[order], values[order].astype(np.float32)
        units = np.arange(1 << 16, dtype=np.uint32)
        # each unit's symbols, packed, and their number
        self.symbols, self.lengths = np.zeros(1 << 16, np.uint32), np.full(1 << 16, DIGITS, np.uint8)
        for k in range(DIGITS):
            self.symbols |= (((units >> (4 * k)) & 0xF) + DIGIT) << (CLASS_BITS * k)
        self.symbols[0], self.lengths[0] = 0, 1
        self.symbols[points], self.lengths[points] = classes, 1

    @staticmethod
    def hashed(grams: np.ndarray) -> np.ndarray:
        """An odd multiple modulo 2 ** 64: different n-grams have different hashes."""
        return grams.astype(np.uint64) * MIX

    def found(self, n: int, kind: str, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if (n, kind) not in self.tables:
            return np.zeros(len(grams), bool), np.zeros(len(grams), np.float32)
        hashes, values = self.tables[n, kind]
        asked = self.hashed(grams)
        place = np.minimum(np.searchsorted(hashes, asked), len(hashes) - 1)
        return hashes[place] == asked, values[place]

    def log_probability(self, grams: np.ndarray) -> np.ndarray:
        """Natural logarithm of each n-gram's last character after the others, by back-off."""
        result, open_, weight = np.zeros(len(grams)), np.ones(len(grams), bool), np.zeros(len(grams))
        for n in range(ORDER, 0, -1):
            part = grams & np.uint64((1 << (CLASS_BITS * n)) - 1)
            known, value = self.found(n, "p", part)
            now = open_ & known
            result[now] = weight[now] + value[now]
            open_ &= ~known
            seen, back = self.found(n, "b", part >> np.uint64(CLASS_BITS))
            weight += np.where(seen, back, 0)
        result[open_] = weight[open_] - np.log(1 << CLASS_BITS)
        return result

    def scores(self, texts: list[str]) -> np.ndarray:
        """Mean negative log probability per character of each text, its log perplexity; a spelled character's is the sum over its digits."""
        points = _points(texts)
        symbols, ends = self.spelled(points)
        grams = symbols[ORDER - 1 :].copy()
        for k in range(1, ORDER):
            grams |= symbols[ORDER - 1 - k : len(symbols) - k] << (CLASS_BITS * k)
        scored = symbols[ORDER - 1 :] != 0
        # each different n-gram is looked up once
        seen = np.zeros(1 << (CLASS_BITS * ORDER), bool)
        seen[grams[scored]] = True
        distinct = np.flatnonzero(seen).astype(np.uint64)
        place = np.searchsorted(distinct, grams[scored]) if len(distinct) < 1000 else self._places(distinct, grams[scored])
        values = np.zeros(len(grams))
        if len(distinct):
            values[scored] = self.log_probability(distinct)[place]
        # lower() may lengthen a text
        lengths = np.array([len(t.lower().encode("utf-16-le")) // 2 for t in texts])
        starts = np.cumsum(lengths + ORDER - 1) - lengths - (ORDER - 1)
        total = np.add.reduceat(np.append(values, 0.0), ends[starts + ORDER - 2] - (ORDER - 1))
        # the second unit of a pair belongs to the character of the first
        characters = (points[ORDER - 1 :] != 0) & (points[ORDER - 1 :] >> 10 != 0x37)
        number = np.add.reduceat(np.append(characters, False).astype(np.int64), starts)
        return -total / np.maximum(number, 1)

    def spelled(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of units, and after how many symbols each unit ends."""
        lengths = self.lengths[points]
        ends = np.cumsum(lengths, dtype=np.int64)
        symbols = np.repeat(self.symbols[points], lengths)
        wide = np.flatnonzero(np.repeat(lengths > 1, lengths))
        # the units' digits come in fours
        symbols[wide] >>= (CLASS_BITS * (DIGITS - 1 - np.arange(len(wide)) % DIGITS)).astype(np.uint32)
        symbols[wide] &= (1 << CLASS_BITS) - 1
        return symbols, ends

    @staticmethod
    def _places(distinct: np.ndarray, grams: np.ndarray) -> np.ndarray:
        table = np.zeros(1 << (CLASS_BITS * ORDER), np.uint32)
        table[distinct] = np.arange(len(distinct), dtype=np.uint32)
        return table[grams]


def _collected(model: DataFrame, classes: DataFrame, langs: list[str]) -> dict[str, SortedModel]:
    """Models of a group of languages, whose size has been checked."""
    table = model.where(F.col("lang").isin(langs)).toArrow()
    letters = classes.where(F.col("lang").isin(langs)).toArrow().to_pandas()
    frame = table.to_pandas()
    found: dict[str, SortedModel] = {}
    for lang, part in frame.groupby("lang"):
        rows = [(int(n), kind, p["gram"].to_numpy(), p["value"].to_numpy()) for (n, kind), p in part.groupby(["n", "kind"])]
        own = letters[letters["lang"] == lang]
        found[lang] = SortedModel(rows, own["point"].to_numpy(np.int64), own["class"].to_numpy(np.uint8))
    return found


def _groups(model: DataFrame) -> list[list[str]]:
    """Languages in groups that stay below ``MODEL_BYTES`` together, or alone; a single language has the bound on its n-grams."""
    groups: list[list[str]] = []
    room = 0
    for row in model.groupBy("lang").count().orderBy("lang").toLocalIterator():
        if not groups or room < 24 * row["count"]:
            groups.append([])
            room = MODEL_BYTES
        groups[-1].append(row["lang"])
        room -= 24 * row["count"]
    return groups


STATS = "doc_id long, tie long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, log_perplexity double"


def measured(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` its doc_id, tie (hash of its text), lang (null: empty), counts and log perplexity (null without a scored character) under its language's model."""
    model, classes = train(docs)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    chosen = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tie"), lang.alias("lang"), F.col("text").cast("string"))
    context = docs.sparkSession.sparkContext
    groups = _groups(model)
    parts = []
    known = [lang for group in groups for lang in group]
    for group in groups or [[]]:
        shared = context.broadcast(_collected(model, classes, group) if group else {})

        def measure(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            models = shared.value
            for whole in batches:
                for at in range(0, whole.num_rows, 500):
                    batch = whole.slice(at, 500)
                    langs, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                    scores: list[float | None] = [None] * len(texts)
                    for lang, places in _by_lang(langs, texts):
                        if lang in models:
                            for p, s in zip(places, models[lang].scores([texts[p] for p in places]).tolist(), strict=True):
                                scores[p] = s
                    columns = list(zip(*map(counts, texts), strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns[:3], *[pa.array(c, pa.int64()) for c in columns], pa.array(scores, pa.float64())],
                        ["doc_id", "tie", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_perplexity"],
                    )
            release()

        # texts of languages without a model have no character to score; they go with the first group
        mine = F.col("lang").isin(group) if parts else ~F.col("lang").isin([x for x in known if x not in group])
        parts.append(chosen.where(mine).mapInArrow(measure, STATS))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def bands(stats: DataFrame, width: float = 3.0, least: float = 0.06) -> DataFrame:
    """Per language the lower and upper bound of log perplexity: quartiles less or plus ``width`` times their distance (``least`` at least).

    Quartiles are over different texts (by ``tie``), so a group of copies weighs as one document. They come from counts per bin, so a language is as many rows as its values span bins, however many documents it has.
    """
    texts = stats.where("log_perplexity is not null").groupBy("lang", "tie").agg(F.min("log_perplexity").alias("log_perplexity"))
    bins = texts.groupBy("lang", F.floor(F.col("log_perplexity") / BIN).alias("bin")).count()
    along = Window.partitionBy("lang").orderBy("bin")
    share = bins.withColumn("until", F.sum("count").over(along) / F.sum("count").over(Window.partitionBy("lang")))
    quartiles = share.groupBy("lang").agg(*[(F.min(F.when(F.col("until") >= q, F.col("bin"))) * BIN).alias(name) for q, name in ((0.25, "q1"), (0.75, "q3"))])
    distance = F.greatest(F.col("q3") - F.col("q1"), F.lit(least))
    return quartiles.select("lang", (F.col("q1") - width * distance).alias("lower"), (F.col("q3") + width * distance).alias("upper"))


def _verdicts(docs: DataFrame, width: float) -> DataFrame:
    stats = cut_lineage(measured(docs), "measured")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = stats.withColumn("base_failed", failed)
    # one row per language
    limits = bands(stats.where("not base_failed"), width)
    inside = F.col("log_perplexity").between(F.col("lower"), F.col("upper"))
    return stats.join(limits, "lang", "left").withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))


def judged(docs: DataFrame, width: float = 3.0) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, counts, ``base_failed``, ``log_perplexity`` and ``kept``.

    Base rule: fewer than 50 words, or over half of them in repeated runs of three, fails. Of the others those outside their language's band
    of perplexity go too. Null languages and the empty one are one language. A null or empty text has counts of 0 and fails. Rows,
    repeated ones and those with a null doc_id too, all stay; other columns are ignored.
    """
    return _verdicts(docs, width).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_perplexity"
    )


def kept_documents(docs: DataFrame, width: float = 3.0) -> DataFrame:
    """Rows of ``docs``, all columns, that ``judged`` keeps; rows equal in doc_id and text are kept or go together."""
    stay = _verdicts(docs, width).groupBy("doc_id", "tie").agg(F.max("kept").alias("kept")).where("kept")
    stay = stay.select(F.col("doc_id").alias("__stay"), F.col("tie").alias("__stay_tie"))
    tied = docs.withColumn("__tie", F.xxhash64(F.col("text").cast("string")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__stay")) & (F.col("__tie") == F.col("__stay_tie"))
    return tied.join(stay, same, "left_semi").select(*[f"`{name}`" for name in docs.columns])
