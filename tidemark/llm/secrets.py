"""Secret scan with multipart credential linking, in DataFrame operations only.

Plain kinds are reported wherever they stand. Weak kinds, which mean little alone, are reported only if the parts they lack stand in
their scope: at most ``SCOPE`` code points between the parts' starts, and no overlap. Secrets meet identifiers and endpoints in
an interval join: parts of a text are dealt by stretches of ``SCOPE`` code points, and a secret asks its own stretch and both beside it. As
matches of a kind do not overlap, what a stretch can hold is bounded, however many parts a text has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.durable import cut_lineage

SCOPE = 400

# Kinds in the order in which spans of one start are listed, with their patterns; plain kinds first.
PLAIN = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{16,}",
}
WEAK = {
    "weak_assign": PLAIN["assign"],
    "weak_id": r"""(?i)(?:access|client|account|tenant|app)[_-]?(?:key)?[_-]?id["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.-]{6,}""",
    "weak_secret": r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{32,}+={0,2}(?![A-Za-z0-9+/=_-])",
    "endpoint": r"""(?i)[a-z][a-z0-9+.-]{1,15}://[^\x20\x09-\x0D"'<>]+""",
}
# What a text must hold for a pattern to be tried on it.
HINTS = {
    "assign": "(?i)password|passwd|secret|token|api_?key",
    "access": "AKIA",
    "hex": "[0-9a-f]{16}",
    "weak_id": "(?i)id[\"']?\\x20*[:=]",
    "weak_secret": "[A-Za-z0-9+/]{32}",
    "endpoint": "://",
}
KINDS = [*PLAIN, *WEAK]


def _found(kind: str, pattern: str) -> Column:
    """Array of (pattern, place, kind or null, gap before it, length) of a pattern's matches; lengths in code points."""
    text = F.col("text")
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.transform(whole, lambda m: F.length(m))
    if kind == "assign":
        value = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(2)), lambda v: F.length(v))
        labels = F.transform(value, lambda n: F.when(n >= 12, "assign").when(n >= 6, "weak_assign"))
    elif kind == "access":
        labels = F.transform(lengths, lambda n: F.when(n >= 18, "access").when(n >= 12, "weak_id"))
    elif kind == "weak_secret":
        mixed = lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")
        labels = F.transform(whole, lambda m: F.when(mixed(m), "weak_secret"))
    else:
        labels = F.transform(whole, lambda m: F.lit(kind))
    # the last gap follows the last match and moves nothing
    zipped = F.transform(
        F.arrays_zip(labels.alias("l"), lengths.alias("n"), F.slice(gaps, 1, F.greatest(F.size(lengths), F.lit(1))).alias("g")),
        lambda z, i: F.struct(F.lit(kind).alias("pattern"), i.alias("place"), z["l"].alias("kind"), z["g"].alias("gap"), z["n"].alias("length")),
    )
    none = F.array().cast("array<struct<pattern:string,place:int,kind:string,gap:int,length:int>>")
    return F.when(text.rlike(HINTS[kind]) & (F.size(whole) > 0), zipped).otherwise(none)


IDS, SECRETS = ("access", "weak_id"), ("assign", "hex", "weak_assign", "weak_secret")


def _parts(docs: DataFrame) -> DataFrame:
    """All matches of ``docs`` as rows: row, doc_id, kind, start, end; a row without kind for a document that has none."""
    patterns = {k: p for k, p in (PLAIN | WEAK).items() if k != "weak_assign"}
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    parts = rows.select("row", "doc_id", F.explode_outer(F.concat(*[_found(k, p) for k, p in patterns.items()])).alias("p"))
    # the rows of a document stay together from here on
    parts = parts.select("row", "doc_id", "p.*").repartition("row")
    along = Window.partitionBy("row", "pattern").orderBy("place")
    placed = parts.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(along)).withColumn("start", F.col("end") - F.col("length"))
    placed = placed.where("kind is not null or pattern is null or place = 0")
    # a path is no secret, whatever it looks like
    earlier = Window.partitionBy("row").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    within = (F.col("kind") == "weak_secret") & (F.max(F.when(F.col("kind") == "endpoint", F.col("end"))).over(earlier) > F.col("start"))
    kind = F.when(F.coalesce(within, F.lit(False)), None).otherwise(F.col("kind"))
    return cut_lineage(placed.select("row", "doc_id", kind.alias("kind"), F.col("start").cast("int"), F.col("end").cast("int")), "parts")


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """A row per secret with parts in its scope: row, doc_id, secret, ids, endpoints (structs of start, end, kind, sorted)."""
    span = F.struct("start", "end", "kind")
    stretch = F.floor(F.col("start") / scope)
    secrets = parts.where(F.col("kind").isin(*SECRETS)).select("row", "doc_id", span.alias("secret"), F.explode(F.array(stretch - 1, stretch, stretch + 1)).alias("stretch"))
    partners = parts.where(F.col("kind").isin(*IDS, "endpoint")).select("row", span.alias("part"), stretch.alias("stretch"))
    near = F.abs(F.col("part.start") - F.col("secret.start")) <= scope
    apart = (F.col("part.end") <= F.col("secret.start")) | (F.col("secret.end") <= F.col("part.start"))
    met = secrets.join(partners, ["row", "stretch"]).where(near & apart)
    of = lambda test: F.sort_array(F.collect_list(F.when(test, F.col("part"))))
    place = F.col("part.kind") == "endpoint"
    linked = met.groupBy("row", "doc_id", "secret").agg(of(~place).alias("ids"), of(place).alias("endpoints"))
    # a blob of signs is a secret only beside an identifier; a word that names one is enough for an endpoint
    return linked.where((F.size("ids") > 0) | ~F.col("secret.kind").isin("weak_secret", "hex"))


def credentials(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Linked credentials: ``doc_id``, ``secret`` and the ``ids`` and ``endpoints`` in its scope, as (start, end, kind), sorted.

    One row per secret that has a complement, of plain kinds too: an identifier, or for secrets that their text names an endpoint.
    """
    return _linked(_parts(docs), scope).drop("row")


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row of ``docs``: ``doc_id`` and ``spans``, an array of (start, order, kind, end), sorted; positions count code points.

    Matches of a kind are the leftmost ones that do not overlap; one that fails its kind's length is dropped, or kept as a weak candidate.
    Weak candidates stay only as parts of ``credentials``, an endpoint only of one with an identifier. A null or empty text has no
    spans. Rows, repeated ones and those with a null doc_id too, all stay; other columns are ignored. An empty table gives no rows.
    """
    parts = _parts(docs)
    linked = cut_lineage(_linked(parts, scope), "credentials")
    used = F.concat(F.array("secret"), "ids", F.when(F.size("ids") > 0, F.col("endpoints")).otherwise(F.slice("endpoints", 1, 0)))
    confirmed = linked.select("row", F.explode(used).alias("p")).select("row", "p.*").where(F.col("kind").isin(*WEAK)).distinct()
    marked = parts.join(confirmed.withColumn("linked", F.lit(True)), ["row", "kind", "start", "end"], "left")
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    span = F.struct("start", place.cast("int").alias("order"), "kind", "end")
    reported = F.col("kind").isin(*PLAIN) | F.col("linked")
    return marked.groupBy("row", "doc_id").agg(F.sort_array(F.collect_list(F.when(reported, span))).alias("spans")).drop("row")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(scanned: DataFrame) -> DataFrame:
    """Counts per plain kind, the SHA-256 of plain spans, and all spans as a string."""
    plain = F.filter("spans", lambda s: s["order"] <= len(PLAIN))
    counts = [F.size(F.array_remove(F.transform("spans", lambda s: F.when(s["kind"] == kind, 1).otherwise(0)), 0)).cast("long").alias(f"n_{kind}") for kind in PLAIN]
    return scanned.select("doc_id", *counts, F.sha2(joined(plain), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
