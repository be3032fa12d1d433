"""Date parsing with declared formats.

A format string lists alternatives separated by ``||``, tried in order. Named formats are mapped to Spark parsing;
anything else is a datetime pattern for ``try_to_timestamp``. Results are ``TIMESTAMP_NTZ`` holding UTC wall time
(docspark sessions run with ``spark.sql.session.timeZone=UTC``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed value: ISO-8601 date with optional time and zone, as accepted by strict_date_optional_time.
ISO_OPTIONAL_TIME = r"^\d{4}-\d{2}-\d{2}(T\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def _ntz(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def _iso(s: Column, rx: str) -> Column:
    return F.when(s.rlike(rx), _ntz(s.try_cast("timestamp")))


def _numeric_string(s: Column) -> Column:
    return F.when(s.rlike(r"^-?\d+$"), s.try_cast("long"))


def parse_one(s: Column, fmt: str, number: Column | None = None) -> Column:
    """Parse string ``s`` (or the JSON number ``number``) with one named format or pattern."""
    f = fmt.strip()
    if f in ("strict_date_optional_time", "date_optional_time", "strict_date_optional_time_nanos"):
        return _iso(s, ISO_OPTIONAL_TIME)
    if f in ("strict_date", "date", "yyyy-MM-dd"):
        return _iso(s, ISO_DATE)
    if f in ("epoch_millis", "epoch_second"):
        n = _numeric_string(s)
        if number is not None:
            n = F.coalesce(number, n)
        return _ntz(F.timestamp_millis(n) if f == "epoch_millis" else F.timestamp_seconds(n))
    return _ntz(F.try_to_timestamp(s, F.lit(f)))


def parse_date(s: Column, formats: list[str], number: Column | None = None) -> Column:
    """First format that parses wins; null when none does."""
    return reduce(lambda a, b: F.coalesce(a, b), [parse_one(s, f, number) for f in formats])


def to_epoch_millis(ts: Column) -> Column:
    """Epoch milliseconds of a UTC wall-clock timestamp (NTZ or LTZ under a UTC session)."""
    return F.unix_millis(ts.cast("timestamp"))


def iso_string(ts: Column) -> Column:
    """``key_as_string`` format: ``yyyy-MM-ddTHH:mm:ss.SSSZ``."""
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
