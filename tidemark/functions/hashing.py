"""Hash keys of records and the queue of a stream."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_QUEUES = 8
# Fixed value: 2^128 - 1.
LARGEST_DECIMAL = "340282366920938463463374607431768211455"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _split_off_word(limbs: list[Column]) -> tuple[list[Column], Column]:
    """Divide base 10^9 limbs (most significant first, the first below 2^32) by 2^32: quotient limbs and rest."""
    base, word = F.lit(10**9), F.lit(2**32)
    quotient, rest = [], limbs[0]
    for limb in limbs[1:]:
        # below 2^32 * 10^9, which a long holds
        part = rest * base + limb
        quotient.append(F.call_function("div", part, word))
        rest = part % word
    return quotient, rest


def decimal_to_hex128(number: Column | str) -> Column:
    """A decimal digit string below 2^128 as 32 lower-case hex digits; any other string raises an error, null stays null.

    2^128 - 1 has 39 digits, one more than Spark's widest decimal, and decimals are slow:
    this divides by 2^32 in long arithmetic. The quotient loses a limb each time.
    """
    plain = F.ltrim(_column(number), F.lit("0"))
    long = F.length(plain)
    fits = _column(number).rlike("^[0-9]+$") & ((long < 39) | ((long == 39) & (plain <= LARGEST_DECIMAL)))
    refuse = F.raise_error(F.concat(F.lit("no hash key below 2^128: "), _column(number))).cast("string")
    digits = F.lpad(F.when(fits | _column(number).isNull(), plain).otherwise(refuse), 45, "0")
    limbs = [F.substring(digits, 1 + 9 * i, 9).cast("long") for i in range(5)]
    words = []
    while len(limbs) > 2:
        limbs, rest = _split_off_word(limbs)
        words.append(rest)
    words.append(limbs[0] * F.lit(10**9) + limbs[1])
    return F.concat(*[F.lpad(F.lower(F.hex(w)), 8, "0") for w in reversed(words)])


def effective_hash_key(partition_key: Column | str, explicit_hash_key: Column | str | None = None) -> Column:
    """The 128-bit key that places a record, as 32 hex digits, so text order is numeric order.

    ``explicit_hash_key`` is a decimal digit string and wins; otherwise the md5 of the
    partition key is taken.
    """
    hashed = F.md5(_column(partition_key).cast("binary"))
    if explicit_hash_key is None:
        return hashed
    # not inside a CASE, where Spark would evaluate the shared parts of the conversion again and again
    return F.coalesce(decimal_to_hex128(explicit_hash_key), hashed)


def route_to_queue(stream: Column | str, namespace: Column | str | None = None, n: int = DEFAULT_QUEUES) -> Column:
    """Queue number 0..n-1 of a stream: the same (stream, namespace) always gets the same queue. A null stream raises an error."""
    if isinstance(n, bool) or not isinstance(n, int) or n < 1:
        raise ValueError(f"number of queues must be a positive integer, got {n!r}")
    refuse = F.raise_error(F.lit("a message needs a stream")).cast("string")
    key = F.coalesce(_column(stream).cast("string"), refuse)
    if namespace is not None:
        key = F.concat(key, F.lit("/"), F.coalesce(_column(namespace).cast("string"), F.lit("")))
    word = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long")
    return F.pmod(word, F.lit(n).cast("long"))
