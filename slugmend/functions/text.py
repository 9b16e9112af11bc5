"""Message and report formatting as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slugmend.schemas import MSG_SEPARATOR


def template(text: str, *args: Column) -> Column:
    """Fill a ``{}`` message template with column values (null prints ``None``)."""
    parts = text.split("{}")
    if len(parts) != len(args) + 1:
        raise ValueError(f"template expects {len(parts) - 1} values, got {len(args)}")
    pieces: list[Column] = [F.lit(parts[0])]
    for value, tail in zip(args, parts[1:]):
        pieces.append(F.coalesce(value.cast("string"), F.lit("None")))
        pieces.append(F.lit(tail))
    return F.concat(*pieces)


def join_messages(*parts: Column) -> Column:
    """``' | '``-join of the non-null parts; null when every part is null."""
    return F.nullif(F.concat_ws(MSG_SEPARATOR, *parts), F.lit(""))


def elapsed_seconds(first: Column, last: Column) -> Column:
    """Whole seconds from ``first`` to ``last``; 0 when either is null."""
    return F.coalesce(F.timestamp_diff("SECOND", first, last), F.lit(0)).cast("bigint")


def format_elapsed(seconds: Column) -> Column:
    """``HHh MMm SSs`` for a non-negative number of seconds."""
    s = seconds.cast("bigint")
    return F.format_string(
        "%02dh %02dm %02ds",
        F.floor(s / 3600).cast("bigint"),
        F.floor((s % 3600) / 60).cast("bigint"),
        (s % 60).cast("bigint"),
    )


def format_run_ts(ts: Column) -> Column:
    """``dd/MM/yyyy HH:mm``, or an em dash when unknown."""
    return F.coalesce(F.date_format(ts, "dd/MM/yyyy HH:mm"), F.lit("—"))


def local_clock(ts: Column, offset: str = "-04:00") -> Column:
    """A UTC instant shown at a fixed offset as ``dd/MM/yyyy às HH:mm``."""
    return F.date_format(F.from_utc_timestamp(ts, offset), "dd/MM/yyyy 'às' HH:mm")
