"""Shard lineage through splits and merges: a graph with up to two parents per node.

Nodes have id, parent_id, adjacent_parent_id, start_seq and end_seq (null while open),
and for coverage start_hash and end_hash as 32 hex digits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.sequence import AT_TIMESTAMP, INITIAL_POSITIONS, LATEST, SHARD_END, TRIM_HORIZON, seq_key
from tidemark.plans.durable import cut_lineage, work_folder
from tidemark.plans.positions import with_positions

# Levels per round: fewer rounds for some repeated work on nodes that were found before.
HOPS_PER_ROUND = 3

KEEP, DELETE, INCONSISTENT = "keep", "delete", "inconsistent"
ABSENT, NOT_CLOSED, NO_CHILDREN, COVERED, NOT_COVERED = "absent", "not closed", "no children", "covered", "not covered"


def _parents(nodes: DataFrame) -> DataFrame:
    """(child, parent) pairs, also of parents that no longer exist; no pair twice."""
    both = F.array_distinct(F.array_compact(F.array("parent_id", "adjacent_parent_id")))
    return nodes.select(F.col("id").alias("child"), F.explode(both).alias("parent"))


def children_of(nodes: DataFrame) -> DataFrame:
    """Edge list (parent, child) over both parent columns, existing parents only."""
    ids = nodes.select(F.col("id").alias("parent"))
    return _parents(nodes).join(ids, "parent", "left_semi").select("parent", "child")


def open_shards(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("end_seq").isNull())


def unclosed_parents(nodes: DataFrame) -> DataFrame:
    """Ids of nodes that have children but no ending sequence number: a torn listing."""
    parents = _parents(nodes).select(F.col("parent").alias("id"))
    return open_shards(nodes).join(parents, "id", "left_semi").select("id")


def hash_coverage(nodes: DataFrame, closed_ids: DataFrame) -> DataFrame:
    """Status of each id expected to be closed: whether its children span its hash range.

    Only the children's least start and greatest end count; gaps between them do not.
    """
    spans = nodes.select(F.col("id").alias("child"), "start_hash", "end_hash")
    # a child has at most two edges, so the join has no hot key; the span is then one row per parent
    span = (
        _parents(nodes)
        .join(spans, "child")
        .groupBy("parent")
        .agg(F.min("start_hash").alias("__least"), F.max("end_hash").alias("__greatest"))
        .withColumnRenamed("parent", "id")
    )
    known = nodes.select("id", "start_hash", "end_hash", "end_seq", F.lit(True).alias("__known"))
    joined = closed_ids.select("id").distinct().join(known, "id", "left").join(span, "id", "left")
    covers = (F.col("__least") <= F.col("start_hash")) & (F.col("__greatest") >= F.col("end_hash"))
    status = (
        F.when(F.col("__known").isNull(), ABSENT)
        .when(F.col("end_seq").isNull(), NOT_CLOSED)
        .when(F.col("__least").isNull(), NO_CHILDREN)
        .when(covers, COVERED)
        .otherwise(NOT_COVERED)
    )
    return joined.select("id", status.alias("status"))


def dependency_gate(nodes: DataFrame, state: DataFrame) -> DataFrame:
    """Whether each node may be read: no parent has a row whose checkpoint is not SHARD_END.

    ``state``: key, checkpoint. Rows that block are picked first, so only those are joined.
    """
    unfinished = state.where(F.col("checkpoint").isNull() | (F.col("checkpoint") != SHARD_END))
    blocked = (
        _parents(nodes)
        .join(unfinished.select(F.col("key").alias("parent")), "parent", "left_semi")
        .select(F.col("child").alias("id"))
        .distinct()
        .withColumn("__blocked", F.lit(True))
    )
    return nodes.select("id").join(blocked, "id", "left").select("id", F.col("__blocked").isNull().alias("ready"))


def garbage_keys(state: DataFrame, nodes: DataFrame) -> DataFrame:
    """Status of each state row (key, parents): ``keep`` if the node exists, else ``delete``,
    or ``inconsistent`` if a recorded parent still exists without the child."""
    ids = nodes.select(F.col("id").alias("__id"))
    exists = ids.select(F.col("__id").alias("key"), F.lit(True).alias("__exists"))
    flagged = state.select("key", "parents").join(exists, "key", "left")
    orphaned = (
        flagged.where(F.col("__exists").isNull())
        .select("key", F.explode("parents").alias("__id"))
        .join(ids, "__id", "left_semi")
        .select("key")
        .distinct()
        .withColumn("__orphaned", F.lit(True))
    )
    status = F.when(F.col("__exists"), KEEP).when(F.col("__orphaned"), INCONSISTENT).otherwise(DELETE)
    return flagged.join(orphaned, "key", "left").select("key", status.alias("status"))


def finished_keys(state: DataFrame, edges: DataFrame) -> DataFrame:
    """Keys that may be deleted: checkpoint SHARD_END, at least one child, a row for every
    child, and no child still at TRIM_HORIZON. ``edges``: parent, child."""
    begun = state.select(F.col("key").alias("child"), F.col("checkpoint").alias("__checkpoint"), F.lit(1).alias("__row"))
    by_parent = (
        edges.join(begun, "child", "left")
        .groupBy("parent")
        .agg(
            F.bool_and(F.col("__row").isNotNull()).alias("__all"),
            F.bool_or(F.coalesce(F.col("__checkpoint") == TRIM_HORIZON, F.lit(False))).alias("__waiting"),
        )
        .where(F.col("__all") & ~F.col("__waiting"))
        .select(F.col("parent").alias("key"))
    )
    return state.where(F.col("checkpoint") == SHARD_END).select("key").join(by_parent, "key", "left_semi")


def order_keys(state: DataFrame, nodes: DataFrame, key: str = "key", position: str | None = None) -> DataFrame:
    """State rows by their node's starting sequence as a number, then by id as text; rows without a node last.

    With ``position`` the place is a column of that name, from 1, and the rows come in no order.
    """
    starts = nodes.select(F.col("id").alias(key), F.col("start_seq").alias("__start"))
    start_key = F.when(F.col("__start").isNotNull(), seq_key("__start"))
    order = [start_key.asc_nulls_last(), F.col(key).cast("string")]
    started = state.join(starts, key, "left")
    placed = with_positions(started, *order, name=position) if position else started.orderBy(*order)
    return placed.drop("__start")


def _reach(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Nodes reachable from ``seeds`` (id) along ``edges`` (from, to) with their least depth.

    Each round goes HOPS_PER_ROUND levels on from the nodes found last and appends the
    new ones to a table in the shared folder, one partition per level. So plans do not
    grow with the depth, and a lost executor costs at most one round.
    """
    spark = seeds.sparkSession
    folder = work_folder(spark, "reach")
    ids = T.StructType([T.StructField("id", seeds.schema["id"].dataType)])
    # levels count from 1 in each round, so all rounds run the same generated code
    written = T.StructType([*ids.fields, T.StructField("round", T.IntegerType()), T.StructField("hop", T.IntegerType())])
    seeds.select("id").distinct().write.parquet(f"{folder}/round=0/hop={HOPS_PER_ROUND}")
    done, found = 0, 1
    while found:
        level = spark.read.schema(ids).parquet(f"{folder}/round={done}/hop={HOPS_PER_ROUND}")
        levels = []
        for hop in range(1, HOPS_PER_ROUND + 1):
            level = level.select(F.col("id").alias("from")).join(edges, "from").select(F.col("to").alias("id")).distinct()
            levels.append(level.withColumn("hop", F.lit(hop)))
        new = (
            reduce(DataFrame.unionByName, levels)
            .groupBy("id")
            .agg(F.min("hop").alias("hop"))
            .join(spark.read.schema(written).parquet(folder), "id", "left_anti")
        )
        seen = Observation()
        counted = new.observe(seen, F.count_if(F.col("hop") == HOPS_PER_ROUND).alias("deepest"))
        done += 1
        counted.write.partitionBy("hop").parquet(f"{folder}/round={done}")
        # levels are contiguous: nothing lies beyond a level without new nodes
        found = seen.get["deepest"]
    depth = (F.col("round") - 1) * HOPS_PER_ROUND + F.col("hop")
    return spark.read.schema(written).parquet(folder).select("id", depth.alias("depth"))


def lineage_closure(nodes: DataFrame, seeds: DataFrame, direction: str) -> DataFrame:
    """Existing ``seeds`` and their ancestors or descendants through both parent columns.

    One row per node with its least distance from a seed, not one per pair of nodes.
    """
    if direction not in ("ancestors", "descendants"):
        raise ValueError(f"direction must be 'ancestors' or 'descendants', got {direction!r}")
    from_to = ("child", "parent") if direction == "ancestors" else ("parent", "child")
    edges = cut_lineage(
        children_of(nodes).select(F.col(from_to[0]).alias("from"), F.col(from_to[1]).alias("to")), "edges"
    )
    existing = nodes.select("id").join(seeds.select("id"), "id", "left_semi")
    return _reach(edges, existing)


def lineage_backfill_plan(nodes: DataFrame, tracked: DataFrame, position: str) -> DataFrame:
    """Which untracked nodes to start reading, and from where, ordered as ``order_keys``.

    ``tracked``: id. Open untracked nodes are always started. Going up from them through
    untracked parents, the parents of a node are started too if any of its parents is
    already read: at LATEST a tracked node or a descendant of one, otherwise every node.
    Such nodes start at TRIM_HORIZON, the others at ``position``; AT_TIMESTAMP is kept for all.
    """
    if position not in INITIAL_POSITIONS:
        raise ValueError(f"position must be one of {INITIAL_POSITIONS}, got {position!r}")
    ids = nodes.select("id")
    known = tracked.select("id").distinct()
    # structs of nulls are equal, unlike nulls
    edges = cut_lineage(children_of(nodes).where("child is not null"), "edges")
    candidates = open_shards(nodes).select("id").join(known, "id", "left_anti")
    untracked = edges.join(known.select(F.col("id").alias("parent")), "parent", "left_anti")
    upwards = untracked.select(F.col("child").alias("from"), F.col("parent").alias("to"))
    if position == LATEST:
        # both walks in one: nodes and edges carry the direction
        walk = lambda df, up, *names: df.select(*[F.struct(F.lit(up).alias("up"), F.col(n).alias("id")).alias(n) for n in names])
        downwards = edges.select(F.col("parent").alias("from"), F.col("child").alias("to"))
        both = cut_lineage(walk(upwards, True, "from", "to").unionByName(walk(downwards, False, "from", "to")), "both")
        tracked_ids = ids.join(known, "id", "left_semi")
        reached = _reach(both, walk(candidates, True, "id").unionByName(walk(tracked_ids, False, "id")))
        visited = reached.where("id.up").select("id.id")
        read = reached.where("not id.up").select("id.id")
    else:
        visited = _reach(upwards, candidates).select("id")
        read = ids

    joining = (
        edges.join(visited.select(F.col("id").alias("child")), "child", "left_semi")
        .join(read.select(F.col("id").alias("parent")), "parent", "left_semi")
        .select("child")
        .distinct()
    )
    parents = untracked.join(joining, "child", "left_semi").select(F.col("parent").alias("id"))
    started = candidates.unionByName(parents).distinct()
    already = read.select("id", F.lit(True).alias("__read")).distinct()
    if position == AT_TIMESTAMP:
        checkpoint = F.lit(AT_TIMESTAMP)
    else:
        checkpoint = F.when(F.col("__read"), TRIM_HORIZON).otherwise(position)
    plan = started.join(already, "id", "left").select("id", checkpoint.alias("checkpoint"))
    return order_keys(plan, nodes, "id")
