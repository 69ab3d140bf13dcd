"""Jaccard join of documents on word n-grams, as a sparse product of the document by n-gram incidence.

The incidence is dealt by blocks of columns (hashes of n-grams), each packed into 64-bit entries of a hash and a
document. Bounds that follow from the sizes of two sets discard work without losing a link:

1. Only columns with two rows or more can add to an overlap. A document of which less than the threshold's share of its
   columns are such is linked with none but equal sets and leaves the product.
2. In any fixed order of the columns, two linked sets share one of their first n - ceil(t n) + 1 columns. The order
   here is rare columns first, so columns that very many documents share hardly ever make a pair meet.
3. Linked sizes differ by the factor t at most, and from the first common column on, both have enough columns left.

Equal sets are one row of the product. Pairs that already are in one component are not multiplied: first each row meets the
row that is the smallest of most of its columns, which also sorts rows into families; then, family by family, rows outside
the largest component meet all others in dense products of blocks, which give no rows but links; the few pairs left, of different
families and components, are verified one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import MIX, in_groups, release, run_hashes, slices, words
from tidemark.llm.components import components, spanning_forest
from tidemark.plans.durable import cut_lineage

HASH_BITS, DOC_BITS = 44, 20
DOC_MASK = np.uint64((1 << DOC_BITS) - 1)
# the document part of an entry that stands for several documents of its flush
SEVERAL = (1 << DOC_BITS) - 1
FLUSH_ENTRIES, FLUSH_DOCS = 1_000_000, 200_000


def shingle_sets(texts: list[str], width: int) -> Iterator[np.ndarray]:
    """For each text the distinct sorted hashes of all runs of ``width`` words; of the whole sequence if it is shorter; of none if empty."""
    raw = [text.encode().lower() for text in texts]
    # a space keeps texts apart
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    starts, ends = words(data)
    hashes = run_hashes(data, starts, ends)
    sizes = np.array([len(r) + 1 for r in raw], np.int64)
    bounds = np.searchsorted(starts, np.append(0, np.cumsum(sizes)))
    runs = shingle_hashes(hashes, width) if len(hashes) >= width else hashes[:0]
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if begin == end:
            yield hashes[:0]
        elif end - begin < width:
            yield shingle_hashes(hashes[begin:end], end - begin)
        else:
            own = np.sort(runs[begin : end - width + 1])
            yield own[np.append(True, own[1:] != own[:-1])]


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, by the hashes of the words."""
    last = len(hashes) - width + 1
    mixed = np.full(last, width, np.uint64)
    for k in range(width):
        mixed = (mixed ^ hashes[k : k + last]) * MIX
        mixed ^= mixed >> np.uint64(29)
    return mixed


def needed(size: np.ndarray | int, percent: int):
    """The least overlap with any set that a set of ``size`` needs for a link."""
    return -(-size * percent // 100)


def _packed(entries: np.ndarray) -> bytes:
    """Sorted entries by byte planes, compressed: the planes of high bytes hardly vary."""
    planes = np.ascontiguousarray(entries.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return len(entries).to_bytes(4, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:4], "little")
    planes = np.frombuffer(pa.decompress(packed[4:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


FLOW = "kind int, block long, flush long, entries binary, weights binary, ids binary"
FLOW_ARROW = pa.schema(
    [("kind", pa.int32()), ("block", pa.int64()), ("flush", pa.int64()), ("entries", pa.binary()), ("weights", pa.binary()), ("ids", pa.binary())]
)
# kinds of rows: a flush's documents, its entries to count, its entries that several of its documents share, counted entries
DOCUMENTS, ASKED, LOCAL, COUNTED = range(4)


def _row(kind: int, block: int, flush: int, entries: bytes, weights: bytes = b"", ids: bytes = b"") -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [{"kind": kind, "block": block, "flush": flush, "entries": entries, "weights": weights, "ids": ids}], FLOW_ARROW
    )


def _incidence(width: int, block_bits: int):
    """Documents to blocks of entries, flush by flush."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        sets: list[np.ndarray] = []
        ids: list = []
        ties: list[int] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            sizes = np.array([len(s) for s in sets], np.int64)
            digests = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64)
            known = np.array([i is not None for i in ids], bool)
            keys = np.array([i or 0 for i in ids], np.int64)
            tie = np.array(ties, np.int64)
            yield _row(DOCUMENTS, number, number, sizes.tobytes() + digests.tobytes() + tie.tobytes(), known.tobytes(), keys.tobytes())
            hashes = np.concatenate([np.zeros(0, np.uint64), *sets])
            docs = np.repeat(np.arange(len(sets), dtype=np.uint64), sizes)
            block = hashes >> np.uint64(64 - block_bits)
            low = (hashes << np.uint64(block_bits)) >> np.uint64(64 - HASH_BITS)
            entries = (low << np.uint64(DOC_BITS)) | docs
            order = np.argsort(block, kind="stable")
            ends = np.searchsorted(block[order], np.arange((1 << block_bits) + 1))
            for b in range(1 << block_bits):
                mine = np.sort(entries[order[ends[b] : ends[b + 1]]])
                if not len(mine):
                    continue
                column = mine >> np.uint64(DOC_BITS)
                first = np.flatnonzero(np.append(True, column[1:] != column[:-1]))
                counts = np.diff(np.append(first, len(mine)))
                asked = mine[first]
                asked[counts > 1] |= DOC_MASK
                yield _row(ASKED, b, number, _packed(asked), np.minimum(counts, 255).astype(np.uint8).tobytes())
                several = np.repeat(counts > 1, counts)
                if several.any():
                    yield _row(LOCAL, b, number, _packed(mine[several]))

        for batch in batches:
            found = (one for texts in slices(batch.column(1)) for group in in_groups(texts) for one in shingle_sets(group, width))
            for key, tie, own in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), found, strict=True):
                sets.append(own)
                ids.append(key)
                ties.append(tie)
                held += len(sets[-1])
                if held >= FLUSH_ENTRIES or len(sets) >= FLUSH_DOCS:
                    yield from flush()
                    number += 1
                    sets, ids, ties, held = [], [], [], 0
        if sets:
            yield from flush()
        sets.clear()
        release()

    return run


def _count_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answer each flush which of its entries are in columns of several documents, with the count's power of two.

    A flush asks once for a column, whatever the number of its documents in it, so no column has more entries than there are flushes.
    Rows come sorted by block, so one block is held at a time.
    """
    held: int | None = None
    parts: list[tuple[int, np.ndarray, np.ndarray]] = []
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] != ASKED:
                yield pa.RecordBatch.from_pylist([row], FLOW_ARROW)
                continue
            if row["block"] != held:
                yield from _counted(held, parts)
                held, parts = row["block"], []
            parts.append((row["flush"], _unpacked(row["entries"]), np.frombuffer(row["weights"], np.uint8)))
    yield from _counted(held, parts)
    parts = []
    release()


def _counted(block: int | None, parts: list[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """The answers of one block to all flushes."""
    if not parts:
        return
    entries = np.concatenate([e for _, e, _ in parts])
    weights = np.concatenate([w for _, _, w in parts])
    order = np.argsort(entries, kind="stable")
    column = entries[order] >> np.uint64(DOC_BITS)
    first = np.flatnonzero(np.append(True, column[1:] != column[:-1]))
    totals = np.add.reduceat(weights[order].astype(np.int64), first)
    several = totals > 1
    rank = np.where(several, np.minimum(np.log2(totals), 15), 255).astype(np.uint8)
    each = np.empty(len(entries), np.uint8)
    each[order] = np.repeat(rank, np.diff(np.append(first, len(entries))))
    ends = np.cumsum([0, *(len(e) for _, e, _ in parts)])
    for (flush, mine, _), lo, hi in zip(parts, ends[:-1], ends[1:], strict=True):
        keep = each[lo:hi] != 255
        if keep.any():
            yield _row(COUNTED, block, flush, _packed(mine[keep]), each[lo:hi][keep].tobytes())


ROWS = "doc_id long, tie long, size long, digest long, columns binary"


def _documents(percent: int):
    """Per flush: each document with its columns shared by several documents, rare ones first, if they are enough for a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            # sorted by flush, so one flush is held at a time
            for row in batch.to_pylist():
                if rows and rows[0]["flush"] != row["flush"]:
                    yield _flush_documents(rows, percent)
                    rows = []
                rows.append(row)
        if rows:
            yield _flush_documents(rows, percent)
        rows = []
        release()

    return run


def _flush_documents(rows: list[dict], percent: int) -> pa.RecordBatch:
    """The documents of one flush from all rows about it."""
    head = next(row for row in rows if row["kind"] == DOCUMENTS)
    sizes, digests, ties = np.frombuffer(head["entries"], np.int64).reshape(3, -1)
    known = np.frombuffer(head["weights"], bool)
    keys = np.frombuffer(head["ids"], np.int64)
    columns, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    ranks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for row in rows:
        if row["kind"] == COUNTED:
            entries, rank = _unpacked(row["entries"]), np.frombuffer(row["weights"], np.uint8)
            column = (entries >> np.uint64(DOC_BITS)) | np.uint64(row["block"] << HASH_BITS)
            several = (entries & DOC_MASK) == DOC_MASK
            ranked = column | (rank.astype(np.uint64) << np.uint64(60))
            columns.append(ranked[~several])
            docs.append((entries[~several] & DOC_MASK).astype(np.int64))
            ranks[row["block"]] = column[several], ranked[several]
    for row in rows:
        if row["kind"] == LOCAL:
            entries = _unpacked(row["entries"])
            column = (entries >> np.uint64(DOC_BITS)) | np.uint64(row["block"] << HASH_BITS)
            plain, ranked = ranks[row["block"]]
            columns.append(ranked[np.searchsorted(plain, column)])
            docs.append((entries & DOC_MASK).astype(np.int64))
    column, doc = np.concatenate(columns), np.concatenate(docs)
    order = np.lexsort((column, doc))
    column = column[order]
    ends = np.searchsorted(doc[order], np.arange(len(sizes) + 1))
    enough = (np.diff(ends) >= needed(sizes, percent)) & (sizes > 0)
    values = [column[ends[i] : ends[i + 1]].tobytes() if enough[i] else None for i in range(len(sizes))]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, mask=~known), pa.array(ties), pa.array(sizes), pa.array(digests), pa.array(values, pa.binary())],
        ["doc_id", "tie", "size", "digest", "columns"],
    )


def _prefix(percent: int):
    """Rows to the columns by which they have to meet their partners, each with the row's other values and the number of its columns from this one on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("size").to_numpy()
            held = batch.column("columns").to_pylist()
            lengths = np.array([len(c) // 8 for c in held], np.int64)
            # columns of this row alone are the rarest and come first
            most = np.maximum(lengths - needed(size, percent) + 1, 0)
            columns = [np.frombuffer(c, np.int64)[:m] for c, m in zip(held, most.tolist(), strict=True)]
            names = [n for n in batch.schema.names if n != "columns"]
            values = [np.repeat(batch.column(n).to_numpy(), most) for n in names]
            flat = np.concatenate([np.zeros(0, np.int64), *columns])
            left = np.repeat(lengths + np.cumsum(most) - most, most) - np.arange(len(flat))
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(left), *map(pa.array, values)], ["column", "left", *names])

    return run


def _overlaps(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for row in batch.to_pylist():
                shared = len(np.intersect1d(np.frombuffer(row["columns_a"], np.int64), np.frombuffer(row["columns_b"], np.int64), assume_unique=True))
                if 100 * shared >= percent * (row["size_a"] + row["size_b"] - shared):
                    a.append(row["a"])
                    b.append(row["b"])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _verified(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs whose Jaccard similarity reaches the threshold, by their whole columns."""
    one = rows.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("columns").alias("columns_a"))
    other = rows.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("columns").alias("columns_b"))
    both = pairs.select("a", "b").join(one, "a").join(other, "b")
    return both.mapInArrow(_overlaps(percent), "a long, b long")


def _classified(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per row of ``docs``: doc_id, tie (hash of its text), size, node (of its class), component (smallest node), class_id, component_id."""
    spark = docs.sparkSession
    # blocks of columns: a power of two, at least as many as shuffle partitions
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block_bits = min(max(6, (parts - 1).bit_length()), 16)
    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("tie"))
    asked = chosen.mapInArrow(_incidence(width, block_bits), FLOW).repartition(parts, "block").sortWithinPartitions("block")
    answers = asked.mapInArrow(_count_columns, FLOW).repartition(parts, "flush").sortWithinPartitions("flush")
    table = cut_lineage(answers.mapInArrow(_documents(percent), ROWS), "sets")

    whole = table.where("size > 0")
    # a class is one row of the product, named by its digest
    rows = cut_lineage(
        whole.where("columns is not null")
        .groupBy("digest", "size")
        .agg(F.max("columns").alias("columns"))
        .select(F.xxhash64("digest", "size").alias("node"), "digest", "size", "columns"),
        "rows",
    )
    shared = rows.select("node", "size", "columns").mapInArrow(_prefix(percent), "column long, left long, node long, size long")
    pivots = cut_lineage(_pivots(cut_lineage(shared, "prefixes"), percent), "pivots")
    nearest = pivots.where("fits > 0").groupBy("a").agg(F.max(F.struct("fits", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    links = cut_lineage(_verified(nearest, rows, percent), "links")
    labels = cut_lineage(components(links), "labels")
    families = cut_lineage(components(pivots.where("strong")).withColumnRenamed("component", "family"), "families")

    def labelled(labels: DataFrame) -> DataFrame:
        return rows.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")

    more = cut_lineage(_family_links(labelled(labels).join(families, "node"), percent), "family-links")
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = cut_lineage(components(links), "labels")
    whole_rows = labelled(labels).join(families, "node", "left").withColumn("family", F.coalesce("family", "node"))
    met = whole_rows.select("node", "size", "columns", "label", "family").mapInArrow(_prefix(percent), "column long, left long, node long, size long, label long, family long")
    strangers = cut_lineage(_strangers(cut_lineage(met, "prefixes"), percent), "strangers")
    more = cut_lineage(_verified(strangers, rows, percent), "stranger-links")
    if not more.isEmpty():
        labels = cut_lineage(components(links.unionByName(more)), "labels")
    named = (
        whole.select("digest", "size", "doc_id")
        .groupBy("digest", "size")
        .agg(F.min("doc_id").alias("class_id"))
        .withColumn("node", F.xxhash64("digest", "size"))
        .join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    least = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = cut_lineage(named.join(least, "component", "left"), "classes")
    return table.drop("columns").join(named, ["digest", "size"], "left")


def similar_sets(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``size`` of its set of ``width``-word shingles, ``class_id`` and ``component_id``.

    Words are runs of anything but space and U+0009 to U+000D, with A-Z lower-cased; a shorter text is one shingle. Two
    documents are linked if 100 * intersection >= ``percent`` * union. ``class_id`` is the smallest doc_id with an equal set,
    ``component_id`` the smallest doc_id that links lead to. A null or empty text has an empty set and is linked with nothing; its ids are its own doc_id.
    Rows of one doc_id count as documents of their own; a row with a null doc_id links like any other, but names no class: where
    all rows of a class have a null doc_id, its ids are null. Other columns are ignored.

    Overlaps are counted on hashes of shingles of 44 bits and the block's number (6 bits, more with over 64 shuffle partitions), equal sets
    are found by a 64-bit hash of 64-bit hashes and their size.
    """
    found = _classified(docs, width, percent)
    own = F.col("size") > 0
    return found.select(
        "doc_id",
        "size",
        F.when(own, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(own, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """Rows of ``docs``, all columns: of each component of ``similar_sets`` the one with the smallest doc_id (null last), and all with an empty set.

    Of rows equal in doc_id and text one stays.
    """
    found = _classified(docs, width, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie")).alias("m")
    linked = found.where("size > 0").groupBy("component").agg(first).select("m.doc_id", "m.tie")
    stay = linked.unionByName(found.where("size = 0").select("doc_id", "tie").distinct())
    stay = cut_lineage(stay.withColumnsRenamed({"doc_id": "__stay", "tie": "__stay_tie"}), "stay")
    tied = docs.withColumn("__tie", F.xxhash64(F.col("text").cast("string")))

    def same(name: str) -> Column:
        return F.col("doc_id").cast("long").eqNullSafe(F.col(name)) & (F.col("__tie") == F.col(f"{name}_tie"))

    kept = tied.join(stay, same("__stay"), "left_semi")
    repeated = found.groupBy(F.col("doc_id").alias("__again"), F.col("tie").alias("__again_tie")).count().where("count > 1").drop("count")
    repeated = cut_lineage(repeated, "repeated")
    if not repeated.isEmpty():
        # only rows that are there several times are dealt by doc_id and text
        once = Window.partitionBy("doc_id", "__tie").orderBy("__tie")
        several = kept.join(repeated, same("__again"), "left_semi").withColumn("__place", F.row_number().over(once)).where("__place = 1")
        kept = kept.join(repeated, same("__again"), "left_anti").unionByName(several.drop("__place"))
    return kept.select(*[f"`{name}`" for name in docs.columns])


def _fits(percent: int) -> str:
    """Whether sizes allow a link, and the columns from a common one on do if it is the first (another common one may say no)."""
    sizes = f"100 * least(size, size_b) >= {percent} * greatest(size, size_b)"
    return f"{sizes} and {100 + percent} * least(left, left_b) >= {percent} * (size + size_b)"


def _pivots(met: DataFrame, percent: int) -> DataFrame:
    """Each row ``a`` with the rows ``b`` that are the smallest of some of its prefix columns: ``fits``, how many allow a link, ``strong``, if they are a tenth."""
    pivot = met.groupBy("column").agg(F.min(F.struct("node", "size", "left")).alias("p"), F.count("*").alias("n")).where("n > 1")
    pairs = met.join(pivot, "column").select("node", "size", "left", F.col("p.node").alias("b"), F.col("p.size").alias("size_b"), F.col("p.left").alias("left_b"))
    fits = F.sum(F.expr(_fits(percent)).cast("int"))
    times = pairs.where("node <> b").groupBy("node", "size", "b").agg(F.count("*").alias("n"), fits.alias("fits"))
    return times.select(F.col("node").alias("a"), "b", "fits", (1000 * F.col("n") >= (100 - percent) * F.col("size")).alias("strong"))


BLOCK_ENTRIES, BLOCK_ROWS = 1_000_000, 2_048
STRIP_CELLS, DENSE_CELLS = 2_000_000, 4_000_000


def _family_product(percent: int):
    """Links between a block of a family's open rows and a block of all its rows: no more than it takes to join their labels.

    The product is taken in strips of rows, and each strip's some columns at a time, so it needs the same memory whatever the block.
    """

    def run(key: tuple, group: pa.Table) -> pa.Table:
        node, size, label = (group.column(c).to_numpy() for c in ("node", "size", "label"))
        asks = group.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        held = [np.frombuffer(c, np.int64) for c in group.column("columns").to_pylist()]
        rows, others = np.flatnonzero(asks), np.flatnonzero(~asks)
        edges = [np.zeros((3, 0), np.int64)]
        if len(rows) and len(others):
            columns = np.unique(np.concatenate([held[r] for r in rows]))
            there = _entries([held[r] for r in others], columns)
            strip = max(1, STRIP_CELLS // len(others))
            names, code = np.unique(label, return_inverse=True)
            for at in range(0, len(rows), strip):
                mine = rows[at : at + strip]
                shared = _product(_entries([held[r] for r in mine], columns), there, len(mine), len(others), len(columns))
                # 100 s >= p (a + b - s), in whole numbers
                linked = (100 + percent) * shared >= percent * (size[mine][:, None] + size[others][None, :])
                linked &= code[mine][:, None] != code[others][None, :]
                x, y = np.nonzero(linked)
                pairs, first = np.unique(code[mine][x] * len(names) + code[others][y], return_index=True)
                found = np.stack([pairs, node[mine][x[first]], node[others][y[first]]])
                # links that join labels which others have joined already are left out
                found = np.concatenate([edges[0], found], 1)
                edges[0] = found[:, spanning_forest(found[0] // len(names), found[0] % len(names))]
            del held, there
            release()
        return pa.table({"a": pa.array(edges[0][1], pa.int64()), "b": pa.array(edges[0][2], pa.int64())})

    return run


def _entries(held: list[np.ndarray], columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of rows in the given columns, as places of columns and rows, by column."""
    entry = np.concatenate(held)
    place = np.minimum(np.searchsorted(columns, entry), len(columns) - 1)
    known = columns[place] == entry
    of = np.repeat(np.arange(len(held), dtype=np.int32), [len(h) for h in held])[known]
    place = place[known].astype(np.int32)
    order = np.argsort(place, kind="stable")
    return place[order], of[order]


def _product(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], m: int, n: int, columns: int) -> np.ndarray:
    """Overlaps of m rows and n others."""
    shared = np.zeros((m, n), np.float32)
    step = max(16, min(4096, DENSE_CELLS // (m + n)))
    for at in range(0, columns, step):
        dense = []
        for (place, of), number in ((left, m), (right, n)):
            lo, hi = np.searchsorted(place, (at, at + step))
            part = np.zeros((number, step), np.float32)
            part[of[lo:hi], place[lo:hi] - at] = 1
            dense.append(part)
        if dense[0].any():
            shared += dense[0] @ dense[1].T
    return shared.astype(np.int64)


def _family_links(rows: DataFrame, percent: int) -> DataFrame:
    """Links inside families between rows of different labels, by blocked products.

    Only rows outside a family's largest label are open; they meet all rows of the family. Blocks are bounded by their entries and rows, a
    row goes to as many tasks as the other side has blocks.
    """
    counted = rows.groupBy("family", "label").agg(F.count("*").alias("n"), F.sum("size").alias("entries"))
    main = F.max(F.struct("n", "label", "entries"))
    sums = counted.groupBy("family").agg(main.alias("main"), F.sum("entries").alias("all"), F.sum("n").alias("n"), F.count("*").alias("labels"))

    def blocks(entries: Column, n: Column) -> Column:
        return F.ceil(F.greatest(entries / BLOCK_ENTRIES, n / BLOCK_ROWS)).cast("int")

    sums = sums.where("labels > 1").select(
        "family",
        F.col("main.label").alias("main"),
        blocks(F.col("all"), F.col("n")).alias("blocks"),
        blocks(F.col("all") - F.col("main.entries"), F.col("n") - F.col("main.n")).alias("open_blocks"),
    )
    dealt = rows.join(sums, "family")
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    wanted = ["family", "node", "size", "label", "columns"]
    asks = dealt.where("label <> main").select(*wanted, place("open_blocks").alias("x"), every("blocks").alias("y"), F.lit(True).alias("asks"))
    there = dealt.select(*wanted, every("open_blocks").alias("x"), place("blocks").alias("y"), F.lit(False).alias("asks"))
    # stated, because rows that the join left dealt by family alone would pass as dealt by block
    blocked = asks.unionByName(there).repartition("family", "x", "y")
    return blocked.groupBy("family", "x", "y").applyInArrow(_family_product(percent), "a long, b long")


def _strangers(met: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a`` < ``b`` of rows with a common prefix column, of different labels and families, whose sizes allow a link."""
    split = met.groupBy("column").agg(
        F.min("label").alias("l"), F.max("label").alias("h"), F.min("family").alias("f"), F.max("family").alias("g")
    )
    open_ = met.join(split.where("l < h and f < g").select("column"), "column")
    other = open_.select("column", F.col("node").alias("b"), *[F.col(c).alias(f"{c}_b") for c in ("size", "left", "label", "family")])
    pairs = open_.join(other, "column").where("node < b and label <> label_b and family <> family_b").where(_fits(percent))
    return pairs.select(F.col("node").alias("a"), "b").distinct()
