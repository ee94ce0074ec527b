"""Scalar column expressions.

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so the
work stays inside whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The event_type texts written to the fraud mart, one per rule.
EVENT_TYPES = {
    "blacklist": "passport in blacklist",
    "passport_expired": "passport not valid",
    "account_expired": "account not valid",
    "city": "different city",
    "amount": "selection of the amount",
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fio(last="last_name", first="first_name", patronymic="patronymic") -> Column:
    """``last || ' ' || first || ' ' || patronymic``; NULL if any part is NULL."""
    return F.concat(_c(last), F.lit(" "), _c(first), F.lit(" "), _c(patronymic))


def expired(valid_to, ts) -> Column:
    """A document valid to day D counts as expired from 00:00:00 of D on.

    This is what comparing ``'YYYY-MM-DD' < 'YYYY-MM-DD HH:MM:SS'`` as text
    yields; a plain ``date < timestamp`` would miss exactly midnight of D.
    NULL ``valid_to`` never fires.
    """
    return F.to_date(_c(ts)) >= _c(valid_to)


def ts_lit(value) -> Column:
    """A wall-clock TIMESTAMP_NTZ literal (no time-zone conversion on the way)."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat() + " 00:00:00"
    return F.lit(value).cast("timestamp_ntz")


def date_lit(value) -> Column:
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(value.isoformat() if isinstance(value, dt.date) else value).cast("date")


def as_interval(seconds: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))


def within_interval(ts, lag_ts, seconds: int | None) -> Column:
    """``ts - limit < lag_ts``; with ``seconds=None`` only ``lag_ts IS NOT NULL``.

    ``None`` reproduces what the original text arithmetic evaluates to (any
    non-NULL previous event qualifies, the limit is never applied).
    """
    if seconds is None:
        return _c(lag_ts).isNotNull()
    return (_c(ts) - as_interval(seconds)) < _c(lag_ts)


def file_date_from_name(name="file_name") -> Column:
    """Batch day from a ``<kind>_DDMMYYYY.<ext>`` file name or path (the last
    such part of a path wins); NULL if absent or not a real date."""
    digits = F.regexp_extract(_c(name), r".*_(\d{8})\.", 1)
    return F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("ddMMyyyy")).cast("date")


def source_name(path="_metadata.file_path") -> Column:
    """Logical daily file name of a path: the ``<kind>_DDMMYYYY.<ext>`` part
    (a file, or a folder of part files written under that name, also as
    ``<column>=<name>`` by a partitioned job), else the last path component."""
    tail = F.substring_index(_c(path), "/", -2)  # no more than the pattern can take, once a row
    named = F.regexp_extract(tail, r"([^/=]+_\d{8}\.[^/.]+)(?:/[^/]*)?$", 1)
    return F.coalesce(F.nullif(named, F.lit("")), F.substring_index(_c(path), "/", -1))
