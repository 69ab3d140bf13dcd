"""Sequence numbers of shard records: digit strings of any length, and sentinels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinel checkpoints, with their place in the order. Numbers rank 0.
AT_TIMESTAMP = "AT_TIMESTAMP"
TRIM_HORIZON = "TRIM_HORIZON"
LATEST = "LATEST"
SHARD_END = "SHARD_END"
SENTINEL_RANK = {AT_TIMESTAMP: -3, TRIM_HORIZON: -2, LATEST: -1, SHARD_END: 1}

# Read positions that name a sequence number instead of a sentinel.
AT_SEQUENCE_NUMBER = "AT_SEQUENCE_NUMBER"
AFTER_SEQUENCE_NUMBER = "AFTER_SEQUENCE_NUMBER"

INITIAL_POSITIONS = (LATEST, TRIM_HORIZON, AT_TIMESTAMP)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_digits(seq: Column | str) -> Column:
    """True for a non-empty string of the digits 0-9; false for null."""
    return F.coalesce(_column(seq).rlike("^[0-9]+$"), F.lit(False))


def seq_key(seq: Column | str, sub: Column | str | None = None) -> Column:
    """A struct that sorts and compares like the extended sequence number.

    Fields: rank (sentinel or number), digits without leading zeros preceded by their
    count, sub-sequence. Digits of any length order as numbers. SHARD_END equals
    SHARD_END whatever the sub-sequence. Other strings, empty and null raise an error.
    """
    seq = _column(seq)
    sub = F.lit(0).cast("long") if sub is None else F.coalesce(_column(sub).cast("long"), F.lit(0))
    rank = F.when(is_digits(seq), F.lit(0))
    for sentinel, place in SENTINEL_RANK.items():
        rank = rank.when(seq == sentinel, F.lit(place))
    refuse = F.raise_error(
        F.concat(F.lit("expected digits or a sentinel checkpoint, got "), F.coalesce(seq, F.lit("null")))
    )
    rank = rank.otherwise(refuse.cast("int"))
    # what is neither a sentinel nor digits has raised an error above
    digits = F.when(seq.isin(*SENTINEL_RANK), F.lit("")).otherwise(F.ltrim(seq, F.lit("0")))
    return F.struct(
        rank.alias("rank"),
        F.length(digits).alias("length"),
        digits.alias("digits"),
        F.when(seq == SHARD_END, F.lit(0).cast("long")).otherwise(sub).alias("sub"),
    )


def validate_sequence(seq: Column | str, sub: Column | str) -> Column:
    """Whether (seq, sub) may be used as a checkpoint: all digits, and sub not negative."""
    return is_digits(seq) & F.coalesce(_column(sub) >= 0, F.lit(False))


def initial_checkpoint(position: Column | str) -> Column:
    """The sentinel checkpoint of an initial position column; other values raise an error."""
    position = _column(position)
    known = F.upper(position).isin(*INITIAL_POSITIONS)
    refuse = F.raise_error(F.concat(F.lit("no initial position: "), F.coalesce(position, F.lit("null"))))
    return F.when(known, F.upper(position)).otherwise(refuse.cast("string"))
