"""Text an entity says. The templates are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPOKEN = "User said "


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def speak(message: Column | str) -> Column:
    return F.concat(F.lit(SPOKEN), _column(message))


def format_journal_line(entity: Column | str, version: Column | str, message: Column | str) -> Column:
    """``User {entity} (version {version}) says: {message}``; a missing message leaves the end empty."""
    return F.concat(
        F.lit("User "),
        _column(entity).cast("string"),
        F.lit(" (version "),
        _column(version).cast("string"),
        F.lit(") says: "),
        F.coalesce(_column(message), F.lit("")),
    )
