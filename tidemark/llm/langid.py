"""Language identification by a linear-chain conditional random field over words.

Words are what white space divides; scripts that do without it give one word per character, and a longer run of others is cut into
consecutive words, so that every character of a text is looked at. A word's features are its affixes, its character n-grams and its places in the languages' lexicons; transitions between the
languages of neighbouring words are learned too. Posteriors come from forward-backward over the whole text, so mixed
texts get a language per word. A text's language is the one with the largest sum of posteriors.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
BUCKETS = 1 << 16
LETTER = re.compile(r"[^\W\d_]")
LONGEST = 40
# scripts written without spaces between words: Thai to Tibetan, Myanmar, Khmer, Tai, Balinese, Javanese, kana and bopomofo, Han
SPACELESS_RANGES = [
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x3005, 0x3007),
    (0x3040, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA980, 0xA9DF), (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF),
]
RANGES = "".join(f"{chr(a)}-{chr(b)}" for a, b in SPACELESS_RANGES)
# vowel signs and the like stay with the character before them
MARKS = "".join(chr(c) for a, b in SPACELESS_RANGES if b < 0x1B000 for c in range(a, b + 1) if unicodedata.category(chr(c))[0] == "M")
SPACELESS = re.compile(f"[{RANGES}]")
PART = re.compile(f"[{RANGES}][{MARKS}]{{0,{LONGEST - 1}}}|[^{RANGES}]{{1,{LONGEST}}}")


def words_of(text: str) -> list[str]:
    """The lower-cased words of a text, none longer than ``LONGEST``; together they hold all its characters but white space."""
    words = text.lower().split()
    if max(map(len, words), default=0) <= LONGEST and (text.isascii() or not SPACELESS.search(text)):
        return words
    return [part for word in words for part in PART.findall(word)]


def word_features(word: str, buckets: dict[str, int]) -> list[int]:
    """Buckets of a lower-cased word's affixes and of its n-grams of two and three characters, ends marked."""
    marked = f"^{word}$"
    grams = {marked[i : i + n] for n in (2, 3) for i in range(len(marked) - n + 1)}
    names = [*(f"<{word[:n]}" for n in (1, 2, 3, 4)), *(f">{word[-n:]}" for n in (1, 2, 3, 4)), *sorted(grams)]
    found = []
    for name in names:
        bucket = buckets.get(name)
        if bucket is None:
            bucket = xxhash.xxh32_intdigest(name) % BUCKETS
            if len(buckets) < 500_000:
                buckets[name] = bucket
        found.append(bucket)
    return found


@dataclass
class LanguageModel:
    """Weights by feature bucket and language, the lexicon's weights by word, and transitions, all in logarithms."""

    languages: list[str]
    weights: np.ndarray
    lexicon: dict[str, int]
    lexicon_weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: Sequence[str], buckets: dict[str, int]) -> np.ndarray:
        """One row of scores per word; zeros for words without a letter."""
        result = np.zeros((len(words), len(self.languages)), np.float32)
        lettered = [i for i, word in enumerate(words) if LETTER.search(word)]
        if lettered:
            features = [word_features(words[i], buckets) for i in lettered]
            starts = np.cumsum([0, *map(len, features[:-1])])
            flat = np.fromiter((f for own in features for f in own), np.int64)
            for at in range(0, len(lettered), 20_000):
                stop = min(at + 20_000, len(lettered))
                end = starts[stop] if stop < len(lettered) else len(flat)
                part = self.weights[flat[starts[at] : end]]
                result[lettered[at:stop]] = np.add.reduceat(part, starts[at:stop] - starts[at], axis=0)
            listed = [(i, self.lexicon[words[i]]) for i in lettered if words[i] in self.lexicon]
            if listed:
                places, entries = zip(*listed, strict=True)
                result[list(places)] += self.lexicon_weights[list(entries)]
        return result


def posterior_sums(model: LanguageModel, emissions: np.ndarray, lengths: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """Per sequence the sum over its ``counted`` words of the languages' posteriors, by forward-backward over all sequences at once.

    ``emissions`` holds the sequences' words one after the other.
    """
    n = len(model.languages)
    order = np.argsort(-lengths, kind="stable")
    starts = np.cumsum(lengths) - lengths
    ordered = np.repeat(starts[order], lengths[order]) + _along(lengths[order])
    times = _along(lengths[order])
    by_time = np.argsort(times, kind="stable")
    flat = ordered[by_time]
    active = np.bincount(times, minlength=1) if len(times) else np.zeros(0, np.int64)
    likely = emissions[flat]
    likely = np.exp(likely - likely.max(axis=1, keepdims=True)) if len(flat) else likely
    use = counted[flat]
    step = np.exp(model.transitions - model.transitions.max()).astype(np.float32)
    forward = np.empty((len(flat), n), np.float32)
    ends = np.cumsum(active)
    now = None
    for t in range(len(active)):
        begin, end = ends[t] - active[t], ends[t]
        now = likely[begin:end] if now is None else (now[: end - begin] @ step) * likely[begin:end]
        now = now / now.sum(axis=1, keepdims=True)
        forward[begin:end] = now
    sums = np.zeros((len(lengths), n))
    backward = np.ones((0, n), np.float32)
    for t in range(len(active) - 1, -1, -1):
        begin, end = ends[t] - active[t], ends[t]
        # sequences that end here start with ones
        if len(backward) < end - begin:
            backward = np.concatenate([backward, np.ones((end - begin - len(backward), n), np.float32)])
        both = forward[begin:end] * backward
        both /= both.sum(axis=1, keepdims=True)
        sums[order[: end - begin]] += both * use[begin:end, None]
        backward = (backward * likely[begin:end]) @ step.T
        backward /= backward.sum(axis=1, keepdims=True)
    return sums


def _along(lengths: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each length n, one after the other."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _switched(texts: dict[int, list[list[str]]], sequences: int, length: int, rng: np.random.Generator) -> tuple[list[list[str]], np.ndarray]:
    """Sequences of words that change between languages now and then, and each word's language."""
    words, gold = [], np.zeros((sequences, length), np.int64)
    languages = sorted(texts)
    for s in range(sequences):
        line: list[str] = []
        while len(line) < length:
            language = languages[rng.integers(len(languages))]
            source = texts[language][rng.integers(len(texts[language]))]
            take = int(min(rng.geometric(1 / 20), length - len(line), len(source)))
            at = int(rng.integers(len(source) - take + 1))
            gold[s, len(line) : len(line) + take] = language
            line += source[at : at + take]
        words.append(line)
    return words, gold


def fit(samples: Sequence[tuple[str, str]], sequences: int = 3000, length: int = 40, epochs: int = 6, lexicon_size: int = 500, seed: int = 7) -> LanguageModel | None:
    """A model from (language, text) samples, by stochastic gradient on the sequence likelihood; None without samples."""
    languages = sorted({lang for lang, _ in samples})
    texts: dict[int, list[list[str]]] = {}
    for lang, text in samples:
        if words := words_of(text):
            texts.setdefault(languages.index(lang), []).append(words)
    if not texts:
        return None
    usual = {k: Counter(w for words in lines for w in words if LETTER.search(w)) for k, lines in texts.items()}
    lexicon: dict[str, int] = {}
    for k in sorted(usual):
        for word, _ in sorted(usual[k].items(), key=lambda x: (-x[1], x[0]))[:lexicon_size]:
            lexicon.setdefault(word, len(lexicon))
    n, rng = len(languages), np.random.default_rng(seed)
    model = LanguageModel(languages, np.zeros((BUCKETS, n), np.float32), lexicon, np.zeros((max(1, len(lexicon)), n), np.float32), np.zeros((n, n)))
    lines, gold = _switched(texts, sequences, length, rng)
    vocabulary: dict[str, int] = {}
    ids = np.array([[vocabulary.setdefault(w, len(vocabulary)) for w in line] for line in lines])
    known: dict[str, int] = {}
    features = [word_features(w, known) if LETTER.search(w) else [] for w in vocabulary]
    listed = np.array([lexicon.get(w, -1) if LETTER.search(w) else -1 for w in vocabulary])
    flat = np.array([f for own in features for f in own], np.int64)
    first = np.cumsum([0, *map(len, features)])
    speed_w, speed_l, speed_t = np.full_like(model.weights, 1e-6), np.full_like(model.lexicon_weights, 1e-6), np.full((n, n), 1e-6)
    batch = 64
    for _ in range(epochs):
        for at in range(0, sequences, batch):
            rows, truth = ids[at : at + batch], gold[at : at + batch]
            used, inverse = np.unique(rows, return_inverse=True)
            sizes = first[used + 1] - first[used]
            own = flat[np.repeat(first[used], sizes) + _along(sizes)]
            word = np.repeat(np.arange(len(used)), sizes)
            scores = np.zeros((len(used), n))
            np.add.at(scores, word, model.weights[own])
            scores += np.where(listed[used, None] >= 0, model.lexicon_weights[listed[used]], 0)
            marginal, pairs = _marginals(scores[inverse.reshape(rows.shape)], model.transitions)
            error = np.zeros((len(used), n))
            np.add.at(error, inverse.reshape(-1), (np.eye(n)[truth] - marginal).reshape(-1, n))
            slope = np.zeros_like(model.weights)
            np.add.at(slope, own, error[word])
            touched = np.unique(own)
            speed_w[touched] += slope[touched] ** 2
            model.weights[touched] += 0.1 * slope[touched] / np.sqrt(speed_w[touched])
            in_list = listed[used] >= 0
            slope_l = np.zeros_like(model.lexicon_weights)
            np.add.at(slope_l, listed[used][in_list], error[in_list])
            speed_l += slope_l**2
            model.lexicon_weights += 0.1 * slope_l / np.sqrt(speed_l)
            seen = np.zeros((n, n))
            np.add.at(seen, (truth[:, :-1].reshape(-1), truth[:, 1:].reshape(-1)), 1)
            slope_t = seen - pairs
            speed_t += slope_t**2
            model.transitions += 0.1 * slope_t / np.sqrt(speed_t)
    return model


def _marginals(emissions: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of sequences of one length, and the expected number of each transition."""
    likely = np.exp(emissions - emissions.max(axis=2, keepdims=True))
    step = np.exp(transitions - transitions.max())
    length = likely.shape[1]
    forward, backward = np.empty_like(likely), np.ones_like(likely)
    for t in range(length):
        now = likely[:, t] if t == 0 else (forward[:, t - 1] @ step) * likely[:, t]
        forward[:, t] = now / now.sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        now = (backward[:, t + 1] * likely[:, t + 1]) @ step.T
        backward[:, t] = now / now.sum(axis=1, keepdims=True)
    both = forward * backward
    pairs = np.zeros_like(step)
    for t in range(length - 1):
        joint = forward[:, t, :, None] * step * (likely[:, t + 1] * backward[:, t + 1])[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return both / both.sum(axis=2, keepdims=True), pairs


def held_out(doc_id: Column) -> Column:
    """The documents that are for testing: crc32 of the id's digits modulo 4 is 2. False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, per_language: int = 300, piece: int = 30_000) -> list[tuple[str, str]]:
    """At most ``per_language`` different (language, text) of each language, by a hash of the text.

    Of a text longer than ``piece`` code points a piece of that length is taken, whose place depends on its hash; so texts of any length
    train. A language's rows are thinned by their hash, to a few times the wanted number of different texts, before any are ranked.
    """
    usable = docs.where("lang is not null and text is not null").where(~held_out(F.col("doc_id")))
    usable = usable.select(F.col("lang").cast("string"), F.col("text").cast("string")).withColumn("draw", F.xxhash64("text"))
    # one number per language, of which the model has a column each
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n")).toLocalIterator()}
    if not sizes:
        return []
    shares = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, 4.0 * per_language / max(n, 1)))])
    thinned = usable.where(F.pmod(F.col("draw"), F.lit(1 << 30)) < F.element_at(shares, F.col("lang")) * (1 << 30))
    spare = F.length("text") - piece
    first = F.when(spare > 0, F.pmod(F.xxhash64("draw"), F.greatest(spare, F.lit(0)) + 1)).otherwise(0).cast("int") + 1
    pieces = thinned.select("lang", "draw", F.substring(F.col("text"), first, F.lit(piece)).alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    chosen = pieces.dropDuplicates(["lang", "draw"]).withColumn("place", place).where(F.col("place") <= per_language)
    return [(r.lang, r.text) for r in chosen.orderBy("lang", "draw").select("lang", "text").toLocalIterator()]


class _Words:
    """Emission rows of words, as many kept as fit in the given room."""

    def __init__(self, model: LanguageModel, most: int = 400_000) -> None:
        self.model, self.most = model, most
        self.place: dict[str, int] = {}
        self.buckets: dict[str, int] = {}
        self.rows = np.zeros((0, len(model.languages)), np.float32)

    def of(self, texts: list[list[str]]) -> np.ndarray:
        fresh = {w for words in texts for w in words if w not in self.place}
        if len(self.place) + len(fresh) > self.most:
            self.place, self.rows = {}, self.rows[:0]
            fresh = {w for words in texts for w in words}
        if fresh:
            new = list(fresh)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.rows = np.concatenate([self.rows, self.model.emissions(new, self.buckets)])
        ids = np.fromiter((i for words in texts for i in map(self.place.__getitem__, words)), np.int64)
        return self.rows[ids]


def predict(docs: DataFrame, model: LanguageModel | None, group_words: int = 1_000_000) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``lang_pred`` and ``score``, the mean posterior of that language over the words with a letter.

    Only the text is looked at. A null text, one without a letter, and any text without a model are ``und`` with score 0.
    Rows, repeated ones and those with a null doc_id too, all stay; other columns are ignored. An empty table gives no rows.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(model)
    most = max(20_000, 4 * group_words // max(4, len(model.languages))) if model else group_words

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        cache = _Words(own) if own else None
        for batch in batches:
            texts = batch.column(1).to_pylist()
            names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            group: list[list[str]] = []
            places: list[int] = []
            held = 0

            def settle() -> None:
                rows = cache.of(group)
                lengths = np.array([len(words) for words in group])
                counted = rows.any(axis=1)
                sums = posterior_sums(own, rows, lengths, counted)
                number = np.maximum(sums.sum(axis=1), 1e-9)
                best = sums.argmax(axis=1)
                for place, b, top in zip(places, best.tolist(), (sums.max(axis=1) / number).tolist(), strict=True):
                    names[place], scores[place] = own.languages[b], min(1.0, max(0.0, top))

            for place, text in enumerate(texts):
                if own and text and LETTER.search(text):
                    group.append(words_of(text))
                    places.append(place)
                    held += len(group[-1])
                    if held >= most:
                        settle()
                        group, places, held = [], [], 0
            if group:
                settle()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(label, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, per_language: int = 300) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``held_out``, ``lang_pred`` and ``score``; the model is learned from the rows not held out."""
    model = fit(training_sample(docs, per_language))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
