"""Batch envelopes: packing, unpacking, filtering and numbering of queue messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.durable import cut_lineage
from tidemark.plans.hot_ranges import find_hot_ranges
from tidemark.plans.running import row_count, running, total

# An envelope is one row, so a batch without bound is written as several of them.
EVENTS_PER_ENVELOPE = 10_000
# the name under which a column's metadata says that it names a batch
BATCH_COLUMN = "names_batch"


def pack_envelopes(
    events: DataFrame,
    stream: Sequence[str],
    batch_key: Sequence[str],
    order: str,
    payload: Sequence[str],
    context: dict[str, Column] | None = None,
    max_events: int = EVENTS_PER_ENVELOPE,
    rows_per_range: float | None = None,
) -> DataFrame:
    """One envelope per batch: its events in order, and its context map taken from the first event.

    ``part`` is 0 and ``parts`` 1; only a batch of more than ``max_events`` events goes on in parts
    1, 2, ..., so that no row grows without limit; ``parts`` is their number. Every event is kept, and :func:`filter_any` and
    :func:`unpack_envelopes` take the parts of a batch for one envelope. The schema marks the columns that name the batch.
    """
    groups = list(dict.fromkeys([*stream, *batch_key]))
    names = list(dict.fromkeys([*groups, order, *payload]))
    context_map = (
        F.create_map(*[c for k, v in context.items() for c in (F.lit(k), v.cast("string"))])
        if context
        else F.lit(None).cast("map<string,string>")
    )
    slim = events.select(*names, context_map.alias("__context"))
    # all parts carry the context of the batch's first event and the number of parts
    ranges = find_hot_ranges(slim, groups, [order], rows_per_range)
    if ranges is None:
        along, whole = Window.partitionBy(*groups).orderBy(order), Window.partitionBy(*groups)
        counted = slim.withColumn("__n", F.row_number().over(along)).withColumn("__all", F.count(F.lit(1)).over(whole))
        first = F.struct(F.first("__context").over(along).alias("context"), _parts_for(F.col("__all"), max_events).alias("parts"))
        numbered = counted.withColumn("__first", first)
    else:
        # one row per batch
        n_parts = _parts_for(F.count(F.lit(1)), max_events)
        batch = slim.groupBy(*groups).agg(F.struct(F.min_by("__context", order).alias("context"), n_parts.alias("parts")).alias("__first"))
        batch = batch.withColumnsRenamed({c: f"__first_{c}" for c in groups})
        same = [F.col(c).eqNullSafe(F.col(f"__first_{c}")) for c in groups]
        numbered = running(slim, groups, [order], {"__n": row_count()}, ranges)
        numbered = numbered.join(batch, same).drop(*[f"__first_{c}" for c in groups])
    parts = numbered.withColumn("part", F.floor((F.col("__n") - 1) / F.lit(max_events)).cast("long"))
    item = F.struct(F.col("__n").alias("n"), F.struct(*payload).alias("event"))
    packed = parts.groupBy(*groups, "part").agg(
        F.array_sort(F.collect_list(item)).alias("__items"),
        F.min_by("__first", "__n").alias("request_context"),
    )
    return packed.select(
        *[F.col(c).alias(c, metadata={**events.schema[c].metadata, BATCH_COLUMN: True}) for c in groups],
        "part",
        F.col("request_context.parts").alias("parts"),
        F.transform("__items", lambda i: i["event"]).alias("events"),
        F.col("request_context.context").alias("request_context"),
    )


def _parts_for(n: Column, max_events: int) -> Column:
    return F.ceil(n / F.lit(max_events)).cast("long")


def batch_columns(envelopes: DataFrame, batch_key: Sequence[str] | None = None) -> list[str]:
    """The columns that name the batch of a part: those given, else those that :func:`pack_envelopes` marked."""
    keys = list(batch_key) if batch_key is not None else [f.name for f in envelopes.schema if f.metadata.get(BATCH_COLUMN)]
    if not keys:
        raise ValueError("envelopes in parts need the columns that name a batch: give batch_key")
    return keys


def require_events(envelopes: DataFrame) -> DataFrame:
    """The same envelopes; one whose ``events`` is null raises an error, an empty array does not."""
    refuse = F.raise_error(F.lit("message contains no events")).cast(envelopes.schema["events"].dataType)
    return envelopes.withColumn("events", F.when(F.col("events").isNotNull(), F.col("events")).otherwise(refuse))


def unpack_envelopes(
    envelopes: DataFrame,
    wanted: Callable[[Column], Column] | None = None,
    batch_key: Sequence[str] | None = None,
    rows_per_range: float | None = None,
) -> DataFrame:
    """One row per wanted event, with ``event`` and ``event_index``.

    The index counts the survivors of the filter from 0; it is not the place in the envelope. Where there is a column ``part``, it
    goes on from part to part of a batch: ``batch_key`` names its columns; without it they are those that :func:`pack_envelopes` marked.
    A part that is there twice counts once for the later ones. Null ``events`` raise an error. For streams
    with parts see ``unpack_stream``.
    """
    envelopes = require_events(envelopes)
    if wanted is not None:
        envelopes = envelopes.withColumn("events", F.filter("events", lambda e: F.coalesce(wanted(e), F.lit(False))))
    kept = [c for c in envelopes.columns if c != "events"]
    if "part" not in envelopes.columns:
        return envelopes.select(*kept, F.posexplode("events").alias("event_index", "event"))
    keys = batch_columns(envelopes, batch_key)
    _refuse_stream(envelopes, "unpack_stream")
    # one number per part, and only of batches with several parts
    slim = _several(envelopes).groupBy(*keys, "part").agg(F.max(F.size("events")).cast("long").alias("__n"))
    slim = cut_lineage(slim, "part-sizes")
    if slim.isEmpty():
        return envelopes.select(*kept, F.posexplode("events").alias("event_index", "event"))
    counted = running(slim, keys, ["part"], {"__until": total(F.col("__n"))}, find_hot_ranges(slim, keys, ["part"], rows_per_range))
    before = counted.select(*[F.col(c).alias(f"__of_{c}") for c in (*keys, "part")], (F.col("__until") - F.col("__n")).alias("__before"))
    before = cut_lineage(before.where("__before > 0"), "earlier-parts")
    same = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in (*keys, "part")]
    offset = F.coalesce("__before", F.lit(0))
    exploded = envelopes.join(before, same, "left").select(*kept, offset.alias("__before"), F.posexplode("events").alias("__place", "event"))
    return exploded.select(*kept, (F.col("__before") + F.col("__place")).cast("int").alias("event_index"), "event")


def _several(envelopes: DataFrame) -> DataFrame:
    """Parts of batches that have, or may have, several."""
    return envelopes.where(F.coalesce(F.col("parts") > 1, F.lit(True))) if "parts" in envelopes.columns else envelopes


def _refuse_stream(envelopes: DataFrame, instead: str) -> None:
    if envelopes.isStreaming:
        raise ValueError(f"parts of a batch may come in different micro-batches: use {instead}")


def filter_any(
    envelopes: DataFrame, predicate: Callable[[Column], Column], batch_key: Sequence[str] | None = None
) -> DataFrame:
    """Whole envelopes with at least one matching event, all their parts; an empty one is dropped, null ``events`` raise an error.

    Where there is a column ``part``, ``batch_key`` names the columns of a batch, as in :func:`unpack_envelopes`. For streams with parts see ``filter_stream``.
    """
    matches = F.exists("events", lambda e: F.coalesce(predicate(e), F.lit(False)))
    envelopes = require_events(envelopes)
    if "part" not in envelopes.columns:
        return envelopes.where(matches)
    keys = batch_columns(envelopes, batch_key)
    _refuse_stream(envelopes, "filter_stream")
    # the names of matching batches, and only of those with several parts
    found = _several(envelopes).where(matches).select(*[F.col(c).alias(f"__of_{c}") for c in keys]).distinct()
    found = cut_lineage(found.withColumn("__found", F.lit(True)), "matching")
    same = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in keys]
    kept = envelopes.join(found, same, "left").where(F.coalesce("__found", F.lit(False)) | matches)
    return kept.select(*[f"`{c}`" for c in envelopes.columns])


def apply_context(
    envelopes: DataFrame, keys: Sequence[str], wanted: Callable[[Column], Column] | None = None, batch_key: Sequence[str] | None = None
) -> DataFrame:
    """Unpacked events with the named context entries as columns; null where the envelope has no context."""
    return unpack_envelopes(envelopes, wanted, batch_key).select(
        "*", *[F.try_element_at("request_context", F.lit(k)).alias(k) for k in keys]
    )


def assign_sequence(
    messages: DataFrame,
    queue: str = "queue_id",
    order: str = "arrival",
    name: str = "seq",
    rows_per_range: float | None = None,
) -> DataFrame:
    """Number the messages of every queue 0, 1, 2, ... in order of arrival."""
    ranges = find_hot_ranges(messages, [queue], [order], rows_per_range)
    numbered = running(messages, [queue], [order], {name: row_count()}, ranges)
    return numbered.withColumn(name, F.col(name) - 1)


def envelope_to_message(envelopes: DataFrame, name: str = "content") -> DataFrame:
    """Envelopes as JSON text, the payload of a queue message."""
    return envelopes.withColumn(name, F.to_json(F.struct("events", "request_context"))).drop("events", "request_context")


def message_to_envelope(messages: DataFrame, event_type: T.DataType, name: str = "content") -> DataFrame:
    """The envelope held in JSON text; ``event_type`` is the type of one event."""
    schema = T.StructType(
        [
            T.StructField("events", T.ArrayType(event_type)),
            T.StructField("request_context", T.MapType(T.StringType(), T.StringType())),
        ]
    )
    parsed = messages.withColumn("__parsed", F.from_json(name, schema))
    return parsed.select(
        *[c for c in messages.columns if c != name],
        F.col("__parsed.events").alias("events"),
        F.col("__parsed.request_context").alias("request_context"),
    )


def queue_depth(messages: DataFrame, queue: str = "queue_id") -> DataFrame:
    """Number of waiting messages per queue."""
    return messages.groupBy(queue).agg(F.count(F.lit(1)).alias("depth"))
