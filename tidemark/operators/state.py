"""Keyed, versioned state: diffs, optimistic merges, staleness, load."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import transitions
from tidemark.operators.transitions import CREATE, EVICT, REMOVE, RENEW, TAKE, UPDATE
from tidemark.plans.durable import cut_lineage
from tidemark.plans.hot_ranges import RANGE, find_hot_ranges
from tidemark.plans.positions import with_positions
from tidemark.plans.running import latest, previous, running, running_since, total

ADDED, REMOVED, CHANGED, UNCHANGED = "added", "removed", "changed", "unchanged"

# Fixed value: an age beyond this, in either direction, is stale whatever the duration.
MAX_AGE_DAYS = 365

OPERATIONS = (CREATE, UPDATE, RENEW, TAKE, EVICT, REMOVE)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str = "key", version: str = "version") -> DataFrame:
    """Each key of two snapshots as added, removed, changed (the version differs) or unchanged."""
    before = old.select(key, F.col(version).alias("old_version"), F.lit(True).alias("__old"))
    after = new.select(key, F.col(version).alias("new_version"), F.lit(True).alias("__new"))
    status = (
        F.when(F.col("__old").isNull(), ADDED)
        .when(F.col("__new").isNull(), REMOVED)
        .when(F.col("old_version").eqNullSafe(F.col("new_version")), UNCHANGED)
        .otherwise(CHANGED)
    )
    return before.join(after, key, "full_outer").select(key, "old_version", "new_version", status.alias("status"))


def shard_list_diff(keys: DataFrame, listing: DataFrame, fresh: DataFrame, key: str = "key") -> DataFrame:
    """Keys missing from a listing and missing still from a fresh one."""
    return (
        keys.select(key).join(listing.select(key), key, "left_anti").join(fresh.select(key), key, "left_anti")
    )


def tracked_keys(current: DataFrame | None, new: DataFrame) -> DataFrame:
    """Existing and new rows together; no existing rows is the empty table."""
    return new if current is None else current.unionByName(new)


def order_desc(state: DataFrame, key: str = "key", position: str | None = None) -> DataFrame:
    """Rows by descending key; with ``position`` the place is a column of that name, from 1, and the rows come in no order."""
    order = F.col(key).desc()
    return with_positions(state, order, name=position) if position else state.orderBy(order)


def versioned_merge(target: DataFrame, changes: DataFrame, payload: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Apply at most one change per key to a keyed table; return the new table and the outcomes.

    ``target``: key, version, owner and payload. ``changes``: key, op, expected_version,
    expected_owner, new_owner and payload. A change whose check fails is reported with
    ``applied`` false and has no effect:

    create  the key is absent; starts at version 0 with the new owner and payload
    update  the version is as expected; takes the payload
    renew   the version is as expected
    take    the version is as expected; takes the new owner
    evict   the owner is as expected, none included; clears the owner
    delete  unconditional

    Any other operation, null too, and a null key in either table raise an error.

    update, renew, take and evict raise the version by 1. Several changes of a key raise
    an error here; see :func:`versioned_merge_ordered`. Only rows with a change are settled and
    written; the others come from ``target`` as they are, without a shuffle if the changes are few.
    """
    target = target.withColumn("key", _required(target, "key", "row"))
    changes = changes.withColumn("key", _required(changes, "key"))
    have = target.select(
        "key",
        F.col("version").alias("__version"),
        F.col("owner").alias("__owner"),
        *[F.col(p).alias(f"__was_{p}") for p in payload],
        F.lit(True).alias("__have"),
    )
    # grouping by the join key costs no further shuffle and shows keys with more than one change
    change = F.struct("op", "expected_version", "expected_owner", "new_owner", *payload)
    grouped = changes.groupBy("key").agg(F.count(F.lit(1)).alias("__n"), F.any_value(change).alias("__change"))
    refuse = F.raise_error(F.concat(F.lit("several changes of key "), F.col("key").cast("string")))
    kind = grouped.schema["__change"].dataType
    only = F.when(F.col("__n") == 1, F.col("__change")).otherwise(refuse.cast(kind))
    asked = grouped.select("key", only.alias("__change")).select("key", "__change.*")
    # an inner join and an anti join can broadcast few changes, an outer join of the whole target cannot
    touched = cut_lineage(have.join(grouped.select("key"), "key", "left_semi"), "touched")
    merged = cut_lineage(asked.join(touched, "key", "left").withColumn("applied", _check()), "merge")

    op, applied = F.col("op"), F.coalesce(F.col("applied"), F.lit(False))
    alive = F.when(applied, op != REMOVE).otherwise(F.coalesce(F.col("__have"), F.lit(False)))
    version = (
        F.when(applied & (op == CREATE), F.lit(0).cast("long"))
        .when(applied, F.col("__version") + 1)
        .otherwise(F.col("__version"))
    )
    owner = (
        F.when(applied & op.isin(CREATE, TAKE), F.col("new_owner"))
        .when(applied & (op == EVICT), F.lit(None))
        .otherwise(F.col("__owner"))
    )
    new_payload = [
        F.when(applied & op.isin(CREATE, UPDATE), F.col(p)).otherwise(F.col(f"__was_{p}")).alias(p) for p in payload
    ]
    settled = merged.where(alive).select("key", version.alias("version"), owner.alias("owner"), *new_payload)
    untouched = target.select("key", "version", "owner", *payload).join(merged.select("key"), "key", "left_anti")
    new_target = untouched.unionByName(settled)
    outcomes = merged.select("key", "op", "applied")
    return new_target, outcomes


def _check() -> Column:
    op = F.col("op")
    exists = F.coalesce(F.col("__have"), F.lit(False))
    same_version = F.coalesce(F.col("__version") == F.col("expected_version"), F.lit(False))
    refuse = F.raise_error(F.concat(F.lit("unknown operation "), F.coalesce(op, F.lit("null"))))
    return (
        F.when(op == CREATE, ~exists)
        .when(op.isin(UPDATE, RENEW, TAKE), exists & same_version)
        .when(op == EVICT, exists & F.col("__owner").eqNullSafe(F.col("expected_owner")))
        .when(op == REMOVE, F.lit(True))
        .otherwise(refuse.cast("boolean"))
    )


def versioned_merge_ordered(
    target: DataFrame,
    changes: DataFrame,
    order: str,
    payload: Sequence[str] = (),
    rows_per_range: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """As :func:`versioned_merge`, with any number of changes per key, applied in ``order``.

    Whether a change applies depends on the one before it, so a key's changes are a chain. Two
    rules shorten chains before anything runs in sequence. A delete makes what came before
    irrelevant, so chains are cut there. And a change that repeats the check of the one
    right before it cannot apply (see :func:`_repeats_a_check`), so of a burst of attempts
    on one version only the first is left. A chain that still spans several ranges of a hot key is cut at their edges: each
    range is summarised as a function of the state it starts from (see :mod:`tidemark.operators.transitions`), the functions are followed
    from range to range, a row each, and then all ranges run at once, each from its own start. Every run
    streams through a task in sorted batches and keeps one row of state. A null key, operation or order raises an error.
    """
    changes = changes.withColumns({name: _required(changes, name) for name in ("key", "op", order)})
    target = target.withColumn("key", _required(target, "key", "row"))
    ranges = find_hot_ranges(changes, ["key"], [order], rows_per_range)
    if ranges is not None:
        changes = ranges.tag(changes)
    is_delete = F.col("op") == REMOVE
    check = F.struct("op", "expected_version", "expected_owner")
    measures = {"__deletes": total(F.when(is_delete, 1).otherwise(0)), "__before": previous(check)}
    counted = running(changes, ["key"], [order], measures, ranges).withColumn("__settled", _repeats_a_check())
    columns = ["op", "expected_version", "expected_owner", "new_owner", *payload]
    links = counted.where(~F.col("__settled")).select(
        "key",
        # a delete is the last link of its chain
        (F.col("__deletes") - F.when(is_delete, 1).otherwise(0)).alias("__chain"),
        (F.lit(None).cast("int") if ranges is None else F.col(RANGE)).alias("__range"),
        F.col(order).alias("__order"),
        *columns,
        F.lit(None).cast("long").alias("version"),
        F.lit(None).cast(target.schema["owner"].dataType).alias("owner"),
    )
    kinds = {f.name: f.dataType for f in links.schema.fields}
    starts = target.select(
        "key",
        F.lit(0).cast(kinds["__chain"]).alias("__chain"),
        F.col("version").cast("long").alias("version"),
        "owner",
        *payload,
    ).withColumn("__piece", F.lit(WHOLE))
    if ranges is None:
        links = links.withColumn("__piece", F.lit(WHOLE))
    else:
        links, starts = _cut_at_ranges(cut_lineage(links, "links"), starts, payload)
    starts = starts.select(
        "key",
        "__chain",
        "__piece",
        F.lit(None).cast(kinds["__order"]).alias("__order"),
        *[F.lit(None).cast(kinds[c]).alias(c) for c in columns if c not in payload],
        *payload,
        "version",
        "owner",
    )
    # null orders sort first, so a chain meets its first state before its changes
    chained = (
        links.select(*starts.columns).unionByName(starts)
        .repartition("key", "__chain", "__piece")
        .sortWithinPartitions("key", "__chain", "__piece", F.col("__order").asc_nulls_first())
    )
    result = T.StructType(
        [
            T.StructField("key", kinds["key"]),
            T.StructField("__chain", T.LongType()),
            T.StructField("__piece", T.IntegerType()),
            T.StructField("__order", kinds["__order"]),
            T.StructField("op", T.StringType()),
            T.StructField("applied", T.BooleanType()),
            T.StructField("version", T.LongType()),
            T.StructField("owner", kinds["owner"]),
            *[T.StructField(p, kinds[p]) for p in payload],
        ]
    )
    settled = counted.where("__settled").select(
        "key",
        F.lit(0).cast("long").alias("__chain"),
        F.lit(WHOLE).alias("__piece"),
        F.col(order).alias("__order"),
        "op",
        F.lit(False).alias("applied"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in result.fields[6:]],
    )
    applied = chained.mapInArrow(_chain_walker(list(payload)), result)
    walked = cut_lineage(applied.unionByName(settled), "merge")

    ends = walked.where(F.col("op").isNull())
    state = F.struct("version", "owner", *payload)
    new_target = (
        ends.groupBy("key")
        .agg(F.max_by(state, F.struct("__chain", "__piece")).alias("s"))
        .select("key", "s.*")
        .where(F.col("version").isNotNull())
    )
    outcomes = walked.where(F.col("op").isNotNull()).select("key", F.col("__order").alias(order), "op", "applied")
    return new_target, outcomes


# the piece of a chain that is not cut
WHOLE = -1


def _required(df: DataFrame, name: str, row: str = "change") -> Column:
    """The column; a row where it is null raises an error."""
    refuse = F.raise_error(F.concat(F.lit(f"a {row} without {name}, key "), F.coalesce(F.col("key").cast("string"), F.lit("null"))))
    return F.when(F.col(name).isNotNull(), F.col(name)).otherwise(refuse.cast(df.schema[name].dataType))


def _cut_at_ranges(links: DataFrame, starts: DataFrame, payload: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Chains over several ranges of a hot key as pieces, one per range; and the state that each chain or piece starts from."""
    spans = links.where("__range is not null").groupBy("key", "__chain").agg(F.min("__range").alias("__first"), F.max("__range").alias("__last"))
    # at most one chain goes over each edge of a range
    long = cut_lineage(spans.where("__first < __last").select("key", "__chain", "__first"), "long-chains")
    of_long = ["key", "__chain"]
    links = links.join(long, of_long, "left").withColumn("__piece", F.when(F.col("__first").isNotNull(), F.col("__range")).otherwise(WHOLE))
    pieces = links.where("__first is not null").drop("__first")

    first_states = starts.join(long, of_long, "left").withColumn("__piece", F.coalesce("__first", F.lit(WHOLE))).drop("__first")
    kinds = {f.name: f.dataType for f in links.schema.fields}
    summary = T.StructType(
        [
            T.StructField("key", kinds["key"]),
            T.StructField("__chain", T.LongType()),
            T.StructField("__piece", T.IntegerType()),
            T.StructField("__run", T.IntegerType()),
            T.StructField("table", T.BinaryType()),
        ]
    )
    decisive = ["key", "__chain", "__piece", "__order", "op", "expected_version", "expected_owner", "new_owner"]
    sorted_pieces = pieces.select(*decisive).repartition("key", "__chain", "__piece").sortWithinPartitions("key", "__chain", "__piece", "__order")
    summaries = cut_lineage(sorted_pieces.mapInArrow(_summaries, summary), "summaries")
    nothing = F.lit(None)
    followed = T.StructType(
        [
            *summary.fields[:3],
            T.StructField("version", T.LongType()),
            T.StructField("owner", kinds["owner"]),
            T.StructField("__named", kinds["__order"]),
        ]
    )
    # per chain its first state and a row for each run of changes
    lines = summaries.select("*", nothing.cast("long").alias("version"), nothing.cast(kinds["owner"]).alias("owner"))
    firsts = first_states.where(F.col("__piece") != WHOLE).select(
        "key", "__chain", "__piece", F.lit(-1).alias("__run"), nothing.cast("binary").alias("table"), "version", "owner"
    )
    in_order = lines.unionByName(firsts).withColumn("__named", nothing.cast(kinds["__order"]))
    in_order = in_order.repartition(*of_long).sortWithinPartitions(*of_long, "__piece", "__run")
    states = cut_lineage(in_order.mapInArrow(_follow, followed), "states")
    # a piece starts with the payload of the change that set it, or of the chain's first state; one row per piece
    named = pieces.select(F.col("key").alias("__key"), F.col("__order").alias("__at"), *payload)
    same = (F.col("key") == F.col("__key")) & (F.col("__named") == F.col("__at"))
    set_by_change = states.where("__named is not null").join(named, same)
    kept = states.where("__named is null").join(first_states.where(F.col("__piece") != WHOLE).select(*of_long, *payload), of_long)
    columns = [*of_long, "version", "owner", *payload, "__piece"]
    later = set_by_change.select(*columns).unionByName(kept.select(*columns))
    return links.drop("__first", "__range"), first_states.select(*columns).unionByName(later)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted changes to the transitions of each piece, run by run."""
    schema = held = None
    changes: list[transitions.Change] = []
    run = 0

    def summarised() -> Iterator[pa.RecordBatch]:
        nonlocal run
        for one in transitions.transitions(changes):
            row = {"key": held[0], "__chain": held[1], "__piece": held[2], "__run": run, "table": one.packed()}
            yield pa.RecordBatch.from_pylist([row], schema)
            run += 1

    for batch in batches:
        if schema is None:
            fields = [batch.schema.field(n) for n in ("key", "__chain", "__piece")]
            schema = pa.schema([*fields, pa.field("__run", pa.int32()), pa.field("table", pa.binary())])
        for row in batch.to_pylist():
            piece = row["key"], row["__chain"], row["__piece"]
            if piece != held:
                if changes:
                    yield from summarised()
                held, changes, run = piece, [], 0
            elif len(changes) >= transitions.RUN:
                yield from summarised()
                changes = []
            changes.append((row["op"], row["expected_version"], row["expected_owner"], row["new_owner"], row["__order"]))
    if changes:
        yield from summarised()


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted first states and transitions of chains to the state in which each piece but the first starts; absent ones have no row."""
    chain = piece = state = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if (row["key"], row["__chain"]) != chain:
                chain, piece, state = (row["key"], row["__chain"]), row["__piece"], None
            if row["table"] is None:
                state = row["version"], row["owner"], None
                continue
            if row["__piece"] != piece:
                piece = row["__piece"]
                if state is not None:
                    out.append((*chain, piece, *state))
            state = transitions.Transition.unpacked(row["table"]).follow(state)
        if out:
            schema = pa.schema([batch.schema.field(n) for n in ("key", "__chain", "__piece", "version", "owner", "__named")])
            columns = zip(schema, zip(*out, strict=True), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(values, field.type) for field, values in columns], schema=schema)


def _repeats_a_check() -> Column:
    """Whether a change fails whatever the state, because the change right before it had the same check.

    After an attempt on version v the version is not v: it never was, or has moved on. After a
    create the key exists. After evicting an owner the owner is not that one.
    """
    before = F.col("__before.value")
    on_version = [UPDATE, RENEW, TAKE]
    same_version = (
        F.col("op").isin(on_version)
        & before["op"].isin(on_version)
        & (F.col("expected_version") == before["expected_version"])
    )
    both_create = (F.col("op") == CREATE) & (before["op"] == CREATE)
    same_owner = (
        (F.col("op") == EVICT) & (before["op"] == EVICT) & (F.col("expected_owner") == before["expected_owner"])
    )
    return F.coalesce(same_version | both_create | same_owner, F.lit(False))


def _chain_walker(payload: list[str]):
    """A function over sorted batches: one outcome row per change, one end row (op null) per chain or piece of one."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, state, schema = None, None, None  # state: (version, owner, payload values) or None

        def end_row() -> dict:
            version, owner, values = state if state else (None, None, [None] * len(payload))
            return {"key": chain[0], "__chain": chain[1], "__piece": chain[2], "version": version, "owner": owner, **dict(zip(payload, values))}

        def rows_out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            if schema is None:
                kept = ["key", "__chain", "__piece", "__order", "op", "version", "owner", *payload]
                fields = [batch.schema.field(name) for name in kept]
                schema = pa.schema([*fields[:5], pa.field("applied", pa.bool_()), *fields[5:]])
            out = []
            for row in batch.to_pylist():
                piece = row["key"], row["__chain"], row["__piece"]
                if chain != piece:
                    if chain is not None:
                        out.append(end_row())
                    chain, state = piece, None
                op = row["op"]
                values = [row[p] for p in payload]
                if op is None:
                    state = (row["version"], row["owner"], values)
                    continue
                if op == CREATE:
                    applied = state is None
                    if applied:
                        state = (0, row["new_owner"], values)
                elif op == REMOVE:
                    applied, state = True, None
                elif op == EVICT:
                    applied = state is not None and state[1] == row["expected_owner"]
                    if applied:
                        state = (state[0] + 1, None, state[2])
                elif op in (UPDATE, RENEW, TAKE):
                    applied = state is not None and state[0] == row["expected_version"]
                    if applied:
                        version, owner, held = state
                        owner = row["new_owner"] if op == TAKE else owner
                        state = (version + 1, owner, values if op == UPDATE else held)
                else:
                    raise ValueError(f"unknown operation {op}")
                out.append({"key": row["key"], "__chain": row["__chain"], "__piece": row["__piece"], "__order": row["__order"], "op": op, "applied": applied})
            if out:
                yield rows_out(out)
        if chain is not None:
            yield rows_out([end_row()])

    return walk


def stale_keys(
    scans: DataFrame,
    duration_seconds: float,
    key: str = "key",
    scan_order: str = "scan_order",
    scan_ts: str = "scan_ts",
    rows_per_range: float | None = None,
) -> DataFrame:
    """Every scanned row with the time its version last changed, and whether it is stale.

    ``scans``: key, scan_order (scans numbered without gaps), scan_ts, owner, version. A key
    first seen unowned has never changed (null) and is stale at once; first seen owned, or
    with a new version, it changed at that scan. A key that misses a scan is forgotten
    and then first seen again. Stale is an age above the duration, or beyond a year.
    """
    ranges = find_hot_ranges(scans, [key], [scan_order], rows_per_range)
    names = scans.columns
    if ranges is not None:
        scans = ranges.tag(scans)
    before = running(
        scans, [key], [scan_order], {"__before": previous(F.struct(F.col(scan_order).alias("at"), "version"))}, ranges
    )
    earlier = F.col("__before.value")
    first = F.col("__before").isNull() | (F.col(scan_order) - earlier["at"] > 1)
    never = F.lit(None).cast(scans.schema[scan_ts].dataType)
    changed = F.when(first, F.when(F.col("owner").isNotNull(), F.col(scan_ts)).otherwise(never)).otherwise(F.col(scan_ts))
    is_change = first | ~earlier["version"].eqNullSafe(F.col("version"))
    marked = before.withColumn("__change", F.when(is_change, F.struct(changed.alias("ts"))))
    carried = running(marked, [key], [scan_order], {"__last": latest(F.col("__change"))}, ranges)
    age = F.timestamp_diff("MICROSECOND", F.col("last_change"), F.col(scan_ts))
    limit = F.lit(int(duration_seconds * 1_000_000)).cast("long")
    year = F.lit(MAX_AGE_DAYS * 86_400 * 1_000_000).cast("long")
    return carried.withColumn("last_change", F.col("__last.ts")).select(
        *names,
        "last_change",
        (F.col("last_change").isNull() | (age > limit) | (F.abs(age) > year)).alias("stale"),
    )


def owner_switches(
    history: DataFrame,
    key: str = "key",
    order: str = "scan_order",
    is_checkpoint: Column | None = None,
    rows_per_range: float | None = None,
) -> DataFrame:
    """Per row how often the owner has changed hands since the key's last checkpoint row.

    A change counts where the row before had an owner and it differs; giving up
    ownership is no change of hands. A checkpoint row sets the count to 0.
    """
    checkpoint = F.lit(False) if is_checkpoint is None else F.coalesce(is_checkpoint, F.lit(False))
    ranges = find_hot_ranges(history, [key], [order], rows_per_range)
    names = history.columns
    marked = history.withColumn("__checkpoint", checkpoint)
    if ranges is not None:
        marked = ranges.tag(marked)
    before = running(marked, [key], [order], {"__before": previous(F.col("owner"))}, ranges)
    old = F.col("__before.value")
    switched = old.isNotNull() & F.col("owner").isNotNull() & (old != F.col("owner"))
    counted = running_since(before, [key], [order], switched, F.col("__checkpoint"), "owner_switches", ranges)
    return counted.select(*names, "owner_switches")


def load_report(
    assignments: DataFrame,
    owners: DataFrame | None = None,
    max_per_owner: int | None = None,
    owner: str = "owner",
    expired: str = "expired",
) -> DataFrame:
    """Per owner its live rows, the target share, and how far it is below the target.

    ``owners`` lists askers that count even without rows. The target is 1 if there are at
    least as many owners as rows, else the rows per owner rounded up, capped at
    ``max_per_owner``; the cut is the spillover.
    """
    live = ~F.coalesce(F.col(expired), F.lit(False)) & F.col(owner).isNotNull()
    # one pass over the rows; all else comes from one small row per owner
    per_owner = cut_lineage(
        assignments.groupBy(owner).agg(F.count_if(live).alias("load"), F.count(F.lit(1)).alias("rows")), "loads"
    )
    loads = per_owner.where("load > 0").select(owner, "load")
    if owners is not None:
        loads = loads.join(owners.select(owner).distinct(), owner, "full_outer").select(
            owner, F.coalesce("load", F.lit(0)).alias("load")
        )
    n_rows = per_owner.agg(F.coalesce(F.sum("rows"), F.lit(0))).scalar()
    n_owners = loads.agg(F.count(F.lit(1))).scalar()
    counted = loads.withColumn("rows", n_rows).withColumn("owners", n_owners)
    share = F.expr("(rows + owners - 1) div owners")
    cap = F.lit(max_per_owner).cast("long") if max_per_owner is not None else share
    many = F.col("rows") > F.col("owners")
    return counted.select(
        owner,
        "load",
        F.when(many, F.least(share, cap)).otherwise(F.lit(1)).cast("long").alias("target"),
        F.when(many, F.greatest(share - cap, F.lit(0))).otherwise(F.lit(0)).cast("long").alias("spillover"),
    ).withColumn("deficit", F.col("target") - F.col("load"))


def rebalance_count(
    report: DataFrame, expired_rows: int | Column = 0, max_move: int = 1, owner: str = "owner"
) -> DataFrame:
    """Per owner below target how many rows it takes, and from whom.

    Expired rows go first, up to the deficit. Only if there are none, rows move from the most
    loaded owner (the first by name among equals): its excess over the target, or 1 if
    it is exactly at the target and more than one is needed, at most ``max_move``.
    """
    top = report.orderBy(F.col("load").desc(), F.col(owner)).limit(1)
    expired = F.lit(expired_rows).cast("long") if isinstance(expired_rows, int) else expired_rows
    full = report.select(owner, "load", "target", F.greatest("deficit", F.lit(0)).alias("needed")).withColumn(
        "__expired", expired
    ).withColumn("__top", top.select(owner).scalar()).withColumn("__top_load", top.select("load").scalar())
    over = F.least(F.col("needed"), F.col("__top_load") - F.col("target"))
    moved = F.when((over == 0) & (F.col("needed") > 1), F.lit(1)).otherwise(F.greatest(over, F.lit(0)))
    from_expired = F.least("needed", "__expired")
    from_top = F.least(moved, F.lit(max_move).cast("long"))
    return full.select(
        owner,
        "needed",
        F.when(F.col("__expired") > 0, from_expired).otherwise(0).cast("long").alias("take_expired"),
        F.when((F.col("__expired") == 0) & (F.col("needed") > 0), from_top).otherwise(0).cast("long").alias("take_moved"),
        F.when((F.col("__expired") == 0) & (F.col("needed") > 0) & (from_top > 0), F.col("__top")).alias("moved_from"),
    )
