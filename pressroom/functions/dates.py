"""Date parsing, formatting and window arithmetic.

All results are ``timestamp_ntz`` holding UTC wall-clock time, computed
without depending on the session time zone: strings that carry an offset are
parsed to an instant and converted with ``unix_micros``; strings without one
are given ``+0000`` before parsing.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F


def ntz(value) -> Column:
    """A timestamp_ntz literal built from its ISO text. ``F.lit(datetime)``
    would make a session-time-zone TIMESTAMP and shift on the cast; a date
    becomes its midnight."""
    if isinstance(value, _dt.datetime):
        text = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def _epoch() -> Column:
    return ntz(_dt.datetime(1970, 1, 1))

# Russian genitive month names, January..December.
RU_MONTHS_GENITIVE = ("января", "февраля", "марта", "апреля", "мая", "июня",
                      "июля", "августа", "сентября", "октября", "ноября", "декабря")
EN_MONTHS = ("January", "February", "March", "April", "May", "June", "July",
             "August", "September", "October", "November", "December")

# Date rules, one per source family (the rules table of the extractors).
RULES = ("rfc822", "iso_zone", "iso_nozone", "iso_prefix", "dotted", "long_en",
         "long_ru", "us_long", "epoch", "relative")
DATE_ONLY_RULES = ("iso_prefix", "dotted", "long_en", "long_ru", "us_long")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# English weekday abbreviations, Sunday first (dayofweek order).
EN_WEEKDAYS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")

_TOKENS = ("yyyy", "MMMM", "MMM", "MM", "dd", "d", "HH", "mm", "ss", "EEE")


def _sql_array(values) -> Column:
    """A constant array of strings as one expression (one call, not one per item)."""
    return F.expr("array(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")")


def format_ntz(ts, pattern: str) -> Column:
    """Format a timestamp_ntz (or date) without the session time zone.

    ``date_format`` goes through the session time zone, so a wall time in a
    daylight-saving gap of that zone would print shifted. The text cast of a
    timestamp_ntz ('yyyy-MM-dd HH:mm:ss[.ffffff]') is time-zone free, so the
    numeric fields are cut from it. Supports the tokens yyyy MMMM MMM MM dd d
    HH mm ss EEE and quoted literals."""
    t = _c(ts).cast("timestamp_ntz")
    iso = t.cast("string")

    def cut(pos, n):
        return F.substring(iso, pos, n)

    def piece(tok):
        if tok == "yyyy":
            return cut(1, 4)
        if tok == "MMMM":
            return F.element_at(_sql_array(EN_MONTHS), cut(6, 2).cast("int"))
        if tok == "MMM":
            return F.element_at(_sql_array([m[:3] for m in EN_MONTHS]), cut(6, 2).cast("int"))
        if tok == "EEE":
            return F.element_at(_sql_array(EN_WEEKDAYS), F.dayofweek(F.to_date(t)))
        if tok == "d":
            return cut(9, 2).cast("int").cast("string")
        return cut(*{"MM": (6, 2), "dd": (9, 2), "HH": (12, 2), "mm": (15, 2), "ss": (18, 2)}[tok])

    parts, i = [], 0
    while i < len(pattern):
        if pattern[i] == "'":
            j = pattern.index("'", i + 1)
            parts.append(pattern[i + 1:j])
            i = j + 1
            continue
        tok = next((k for k in _TOKENS if pattern.startswith(k, i)), None)
        if tok:
            parts.append(piece(tok))
            i += len(tok)
        else:
            parts.append(pattern[i])
            i += 1
    # Merge adjacent literal characters into one literal.
    merged: list = []
    for p in parts:
        if isinstance(p, str) and merged and isinstance(merged[-1], str):
            merged[-1] += p
        else:
            merged.append(p)
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in merged])


def utc_ntz(instant: Column) -> Column:
    """TIMESTAMP (an instant) -> timestamp_ntz of its UTC wall clock."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())


def epoch_seconds_ntz(secs) -> Column:
    """Epoch seconds (UTC) -> timestamp_ntz."""
    return F.timestamp_add("SECOND", _c(secs).cast("long"), _epoch())


def ntz_epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of a timestamp_ntz, from its own
    fields. (``timestampdiff`` on timestamp_ntz goes through the session time
    zone and is off by an hour across a daylight-saving change;
    ``timestampadd`` and interval arithmetic are exact.)"""
    t = _c(ts).cast("timestamp_ntz")
    days = F.datediff(F.to_date(t), F.lit(_dt.date(1970, 1, 1))).cast("long")
    whole = days * 86400 + F.hour(t).cast("long") * 3600 + F.minute(t).cast("long") * 60
    return whole * 1_000_000 + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")


def ntz_epoch_seconds(ts) -> Column:
    t = _c(ts).cast("timestamp_ntz")
    days = F.datediff(F.to_date(t), F.lit(_dt.date(1970, 1, 1))).cast("long")
    return (days * 86400 + F.hour(t).cast("long") * 3600 + F.minute(t).cast("long") * 60
            + F.second(t).cast("long"))


def _parse_utc(s: Column, pattern: str | None) -> Column:
    """Parse a zoneless string as UTC."""
    if pattern is None:
        return utc_ntz(F.try_to_timestamp(F.concat(s, F.lit("+00:00"))))
    return utc_ntz(F.try_to_timestamp(F.concat(s, F.lit(" +0000")), F.lit(pattern + " Z")))


def ru_month_to_en(s: Column) -> Column:
    """Replace a Russian genitive month name by the English one."""
    mapping = F.expr("map(" + ", ".join(f"'{ru}', '{en}'" for ru, en in zip(RU_MONTHS_GENITIVE, EN_MONTHS)) + ")")
    parts = F.regexp_extract_all(s, F.lit(r"(\S+)"), 1)
    return F.array_join(F.transform(parts, lambda w: F.coalesce(F.element_at(mapping, F.lower(w)), w)),
                        " ")


def _plain_offset(s: Column) -> Column:
    """An offset at the end as +hhmm, whether written so, as +hh:mm or as Z."""
    return F.regexp_replace(F.regexp_replace(s, r"([+-][0-9]{2}):([0-9]{2})$", "$1$2"), r"Z$", "+0000")


def parse_date(c, rule: str, as_of: _dt.datetime | None = None,
               tz_mode: str = "utc") -> Column:
    """Parse one date string with a named rule; null when it does not parse.

    ``tz_mode='utc'`` converts zoned strings to UTC; ``'drop'`` keeps the
    wall clock and ignores the offset.
    """
    s = F.trim(_c(c))
    if rule == "rfc822":
        body = F.regexp_replace(s, r"^[A-Za-z]{3},\s*", "")
        if tz_mode == "drop":
            return _parse_utc(F.regexp_replace(body, r"\s*([+-][0-9]{2}:?[0-9]{2}|Z)$", ""), "d MMM yyyy HH:mm:ss")
        return utc_ntz(F.try_to_timestamp(_plain_offset(body), F.lit("d MMM yyyy HH:mm:ss Z")))
    if rule == "iso_zone":
        if tz_mode == "drop":
            return _parse_utc(F.substring(s, 1, 19), None)
        return utc_ntz(F.coalesce(F.try_to_timestamp(_plain_offset(s), F.lit("yyyy-MM-dd'T'HH:mm:ssZ")),
                                  F.try_to_timestamp(s)))
    if rule == "iso_nozone":
        return _parse_utc(s, None)
    if rule == "iso_prefix":
        return _parse_utc(F.substring(s, 1, 10), "yyyy-MM-dd")
    if rule == "dotted":
        return _parse_utc(s, "d.M.yyyy")
    if rule == "long_en":
        return _parse_utc(s, "d MMMM yyyy")
    if rule == "long_ru":
        return _parse_utc(ru_month_to_en(s), "d MMMM yyyy")
    if rule == "us_long":
        return _parse_utc(s, "MMMM d, yyyy")
    if rule == "epoch":
        return epoch_seconds_ntz(s.try_cast("long"))
    if rule == "relative":
        if as_of is None:
            raise ValueError("relative dates need as_of")
        now = ntz(as_of)
        hours = F.regexp_extract(s, r"^([0-9]+) hours? ago$", 1)
        return (F.when(hours != "", F.timestamp_add("HOUR", -hours.cast("long"), now))
                .when(s.contains("ago"), now))
    raise ValueError(f"unknown date rule {rule!r}")


def render_date(ts, rule: str, as_of: _dt.datetime | None = None) -> Column:
    """Render a timestamp_ntz the way a source of this rule publishes it."""
    t = _c(ts)
    if rule == "rfc822":
        return F.concat(format_ntz(t, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    if rule == "iso_zone":
        return F.concat(format_ntz(t, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0000"))
    if rule == "iso_nozone":
        return format_ntz(t, "yyyy-MM-dd'T'HH:mm:ss")
    if rule == "iso_prefix":
        return F.concat(format_ntz(t, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z"))
    if rule == "dotted":
        return format_ntz(t, "dd.MM.yyyy")
    if rule == "long_en":
        return format_ntz(t, "d MMMM yyyy")
    if rule == "long_ru":
        months = _sql_array(RU_MONTHS_GENITIVE)
        return F.concat_ws(" ", F.dayofmonth(t).cast("string"),
                           F.element_at(months, F.month(t)), F.year(t).cast("string"))
    if rule == "us_long":
        return format_ntz(t, "MMMM d, yyyy")
    if rule == "epoch":
        return ntz_epoch_seconds(t).cast("string")
    if rule == "relative":
        now = ntz(as_of)
        hours = F.floor((ntz_epoch_seconds(now) - ntz_epoch_seconds(t)) / 3600).cast("long")
        return F.concat(hours.cast("string"), F.lit(" hours ago"))
    raise ValueError(f"unknown date rule {rule!r}")


def week_start(ts) -> Column:
    """Monday 00:00 of the week holding ``ts`` (ISO weeks), time-zone free."""
    return F.date_sub(F.next_day(F.to_date(_c(ts)), "Mon"), 7).cast("timestamp_ntz")


def age_days(published_at, as_of: _dt.date) -> Column:
    """Whole days from the publication date to ``as_of``."""
    return F.datediff(F.lit(as_of), F.to_date(_c(published_at))).cast("long")


def ingest_window(as_of: _dt.date, last_success) -> tuple[Column, Column]:
    """(start, end) of an ingest run on day ``as_of``: start is the later of
    this week's Monday and the day after the last success; end is the last
    second of yesterday."""
    today = ntz(as_of)
    monday = week_start(today)
    after_last = F.timestamp_add("DAY", F.lit(1), _c(last_success))
    start = F.greatest(monday, after_last)
    end = F.timestamp_add("SECOND", F.lit(-1), today)
    return start, end
