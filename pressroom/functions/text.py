"""String scalars (JVM-side column expressions, no Python UDFs)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

from pressroom.functions.dates import format_ntz

# Python's str.strip() removes Unicode whitespace including NBSP, U+0085 and
# U+001C-001F; Spark's trim() removes spaces only. Whitespace there means a
# separator (category Zs) or a character of bidirectional class WS, B or S.
# btrim with an explicit set is a single scan per end, cheaper than an anchored
# regex over every whitespace run.
WS_CHARS = "".join(ch for ch in map(chr, range(0x10000)) if unicodedata.category(ch) == "Zs"
                   or unicodedata.bidirectional(ch) in ("WS", "B", "S"))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Unicode-aware strip of leading and trailing whitespace."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def clean_ws_v1(c) -> Column:
    """Runs of spaces -> one space, runs of CR/LF -> one newline, then strip."""
    x = F.regexp_replace(_c(c), " +", " ")
    x = F.regexp_replace(x, r"[\r\n]+", "\n")
    return strip(x)


def clean_ws_v2(c) -> Column:
    """Runs of newlines -> one newline, strip, then runs of spaces -> one space."""
    x = F.regexp_replace(_c(c), r"\n+", "\n")
    return F.regexp_replace(strip(x), " +", " ")


def clean_ws_v3(c) -> Column:
    """Runs of newlines -> one newline only."""
    return F.regexp_replace(_c(c), r"\n+", "\n")


def is_blank(c) -> Column:
    """Null, empty or whitespace-only."""
    return F.coalesce(strip(c), F.lit("")) == ""


def first_int(c) -> Column:
    """First run of ASCII digits as a number, 0 when there is none or the
    text is null/empty. Returned as double so 25-digit runs stay finite."""
    digits = F.regexp_extract(F.coalesce(_c(c), F.lit("")), "[0-9]+", 0)
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("double"), F.lit(0.0))


def vector_to_text(c) -> Column:
    """array<float|double> -> comma-joined decimals (the edge text codec)."""
    return F.array_join(F.transform(_c(c), lambda x: x.cast("double").cast("string")), ",")


def text_to_vector(c) -> Column:
    """Comma-joined decimals -> array<double>; '' or null -> null (no vector)."""
    parts = F.filter(F.split(_c(c), ","), lambda s: F.trim(s) != "")
    return F.when(F.size(parts) > 0, F.transform(parts, lambda s: F.trim(s).cast("double")))


def news_label(title, published_at) -> Column:
    """'title (yyyy-MM-dd HH:mm:ss)'."""
    return F.format_string("%s (%s)", _c(title),
                           format_ntz(_c(published_at), "yyyy-MM-dd HH:mm:ss"))


def digest_label(id_, start, end) -> Column:
    """'id-start-end' with ISO dates."""
    return F.concat_ws("-", _c(id_).cast("string"), _c(start).cast("string"), _c(end).cast("string"))


def contains_ci(c, word: str) -> Column:
    """Case-insensitive substring test (null-safe: null text never matches)."""
    return F.coalesce(F.instr(F.lower(_c(c)), word.lower()) > 0, F.lit(False))
