"""Ranked lexical search, term at a time with a limit on accumulators.

:func:`build_index` cuts the documents into shards of a bounded number of postings and writes, per shard, the lengths of its
documents and a list of postings for every term. :func:`search` joins the queries' terms to the lists, block of queries by
block; the sums of the lists' lengths are the document frequencies. Then each shard answers all queries of the block by itself: a query's terms come rarest
first and add to accumulators of documents. As soon as the bounds of the terms to come are together less than
the k-th highest partial score, no further document can enter the best k, so no accumulator is created any more, and
the documents that have one are updated to their exact scores. The best k over all shards are among the shards' best k.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans.durable import cut_lineage, work_folder

SHARD_POSTINGS, SHARD_DOCS = 1_000_000, 50_000
BLOCK_BYTES = 4_000_000  # of query texts in one block

# bytes of terms, A-Z lower-cased; all others become spaces. Bytes of characters outside ASCII belong to terms
TERM_BYTES = bytes(b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256)).lower()

SHARDS = "shard long, term binary, n int, docs array<int>, times array<int>, doc_ids array<long>, lengths array<long>"


def terms_of(text: str) -> list[bytes]:
    """Maximal runs of letters and digits of ASCII and of any characters beyond it, in UTF-8, with A-Z lower-cased."""
    return text.encode().translate(TERM_BYTES).split()


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to shards: a row without a term holds the documents, every other one a term's postings."""
    shard = TaskContext.get().partitionId() << 32
    doc_ids: list[int | None] = []
    lengths: list[int] = []
    terms: dict[bytes, int] = {}
    places: list[int] = []
    times: list[int] = []
    widths: list[int] = []

    def written() -> pa.RecordBatch:
        names = list(terms)
        term, doc = np.array(places, np.int64), np.repeat(np.arange(len(doc_ids), dtype=np.int32), widths)
        # documents are in order already
        order = np.argsort(term, kind="stable")
        numbers = np.bincount(term, minlength=len(names)).astype(np.int32)
        offsets = pa.array(np.concatenate([np.zeros(2, np.int32), np.cumsum(numbers, dtype=np.int32)]))
        rows = len(names) + 1

        def postings(values: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(offsets, pa.array(values[order].astype(np.int32)))

        def head(values: list) -> pa.Array:
            ends = np.append(0, np.full(rows, len(values))).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int64()))

        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(rows, shard)),
                pa.array([None, *names], pa.binary()),
                pa.array(np.append(0, numbers).astype(np.int32)),
                postings(doc),
                postings(np.array(times, np.int64)),
                head(doc_ids),
                head(lengths),
            ],
            ["shard", "term", "n", "docs", "times", "doc_ids", "lengths"],
        )

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = terms_of(text or "")
            if not found:
                continue
            counted = Counter(found)
            places += [terms.setdefault(term, len(terms)) for term in counted]
            times += counted.values()
            widths.append(len(counted))
            doc_ids.append(doc_id)
            lengths.append(len(found))
            if len(places) >= SHARD_POSTINGS or len(doc_ids) >= SHARD_DOCS:
                yield written()
                shard += 1
                for held in (doc_ids, lengths, terms, places, times, widths):
                    held.clear()
    if doc_ids:
        yield written()


def build_index(docs: DataFrame, path: str) -> None:
    """Write an index of ``docs`` (doc_id, text) to ``path``.

    Every row is a document of its own. Null and empty texts, and those without a term, are in no shard.
    """
    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    chosen.mapInArrow(_shards, SHARDS).write.parquet(path)


def _query_blocks(queries: DataFrame) -> Iterator[list[tuple[int, Counter]]]:
    """The distinct queries (query, text) in blocks of a bounded size, each with its terms."""
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // (BLOCK_BYTES // 2)) or 1
    for block in range(blocks):
        mine = queries if blocks == 1 else queries.where(F.pmod("query", F.lit(blocks)) == block)
        yield [(row["query"], Counter(terms_of(row["text"]))) for row in mine.toLocalIterator()]


def ranked(postings: dict[bytes, tuple[np.ndarray, np.ndarray, int]], order: list[tuple[bytes, int]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents and exact scores that hold the best ``k`` of a shard, and the number of accumulators created.

    ``postings``: per term its documents in ascending order, what one occurrence of the term in the query adds to each, and the most of that;
    ``order``: the query's terms, rarest first, with their number of occurrences.
    """
    bounds = np.array([often * postings[term][2] for term, often in order], np.int64)
    # of a term and all that follow it
    rest = np.cumsum(bounds[::-1])[::-1]
    scores = np.zeros(n_docs, np.int64)
    alive: np.ndarray | None = None
    for (term, often), remaining in zip(order, rest, strict=True):
        docs, adds, _ = postings[term]
        if alive is None:
            held = np.flatnonzero(scores)
            # a document without an accumulator must pass the k-th; with an equal score its smaller doc_id may let it
            if len(held) >= k and remaining < np.partition(scores[held], len(held) - k)[len(held) - k]:
                alive = held
        if alive is None:
            scores[docs] += often * adds
        else:
            place = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
            hit = docs[place] == alive
            scores[alive[hit]] += often * adds[place[hit]]
    held = np.flatnonzero(scores) if alive is None else alive
    found = scores[held]
    if len(held) > k:
        best = found >= np.partition(found, len(held) - k)[len(held) - k]
        return held[best], found[best], len(held)
    return held, found, len(held)


def _answers(shared, k: int):
    """Shards' heads and matched lists to the shards' best documents of every query of the block."""

    def run(key: tuple, heads: pa.Table, lists: pa.Table) -> pa.Table:
        queries, weights, n_all, length_all = shared.value
        nothing = pa.table({"query": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        if not lists.num_rows or not heads.num_rows:
            return nothing
        doc_ids, lengths = heads.column("doc_ids")[0].as_py(), heads.column("lengths")[0].as_py()
        # in Python's integers, which do not overflow
        scale = 8 * np.array([25 + 75 * n * n_all // length_all for n in lengths], np.int64)
        postings = {}
        for row in range(lists.num_rows):
            term = lists.column("term")[row].as_py()
            docs = lists.column("docs")[row].values.to_numpy()
            times = lists.column("times")[row].values.to_numpy().astype(np.int64)
            adds = weights[term][1] * (1_000_000_000 * times // (1000 * times + scale[docs]))
            if adds.any():
                postings[term] = docs, adds, int(adds.max())
        no_id = np.array([i is None for i in doc_ids], bool)
        ids = np.array([i or 0 for i in doc_ids], np.int64)
        found = []
        for query, terms in queries:
            order = sorted(((t, n) for t, n in terms.items() if t in postings), key=lambda e: (weights[e[0]][0], e[0]))
            if order:
                docs, scores, _ = ranked(postings, order, len(doc_ids), k)
                first = np.lexsort((ids[docs], no_id[docs], -scores))[:k]
                found.append((np.full(len(first), query), docs[first], scores[first]))
        if not found:
            return nothing
        query, docs, scores = (np.concatenate(a) for a in zip(*found, strict=True))
        return pa.table({"query": pa.array(query, pa.int64()), "doc_id": pa.array(ids[docs], mask=no_id[docs]), "score": pa.array(scores, pa.int64())})

    return run


def search(spark: SparkSession, path: str, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` documents of the index with the highest scores above 0 for each row of ``items`` (item_id, text).

    Returns ``item_id``, ``rank`` (from 1), ``doc_id`` and ``score``, equal scores by ascending doc_id, null last. With N the documents
    that hold a term, L all their terms, n a document's terms, df a term's documents and tf its times in one, a term's weight w is
    floor(1000 ln((2N + 2) / (2df + 1))), a document's m is 25 + 75nN div L, and its score the sum of w * (1000000000tf div (1000tf + 8m))
    over the query's terms, repeats included.

    Items without a term, or whose terms no document holds, have no rows. Rows equal in item_id and text are one query; of one item_id (null
    too) with several texts each is a query with ranks of its own. Repeated documents each take a rank. Other columns are ignored.
    """
    index = spark.read.schema(SHARDS).parquet(path)
    queries = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text <> ''").distinct()
    # written, so that their numbers hold
    queries = cut_lineage(queries.withColumn("query", F.monotonically_increasing_id()), "queries")
    heads = index.where("term is null").select(F.col("shard").alias("of"), "doc_ids", "lengths")
    totals = heads.agg(F.sum(F.size("doc_ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b))).first()
    n_all, length_all = totals[0] or 0, totals[1] or 0
    found = None
    for block in _query_blocks(queries):
        wanted = spark.createDataFrame([(bytearray(t),) for t in sorted({t for _, terms in block for t in terms})], "term binary")
        # as many rows as the block has terms
        lists = index.where("term is not null").select("shard", "term", "n", "docs", "times").join(wanted, "term", "left_semi")
        frequency = lists.groupBy("term").agg(F.sum("n").alias("df"))
        weight = F.floor(1000 * F.log((2 * F.lit(n_all) + 2) / (2 * F.col("df") + 1))).cast("long")
        weights = {bytes(row["term"]): (row["df"], row["w"]) for row in frequency.select("term", "df", weight.alias("w")).toLocalIterator()}
        shared = spark.sparkContext.broadcast((block, weights, n_all, length_all))
        both = heads.groupBy("of").cogroup(lists.drop("n").groupBy("shard"))
        best = both.applyInArrow(_answers(shared, k), "query long, doc_id long, score long")
        found = best if found is None else found.unionByName(best)
    place = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return top.join(queries, "query").select("item_id", "rank", "doc_id", "score")


def search_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """:func:`search` over an index of ``docs``, written to a new folder of the shared one."""
    path = work_folder(docs.sparkSession, "index")
    build_index(docs, path)
    return search(docs.sparkSession, path, items, k)
