"""Joins of the article workflow.

* ``masked_update`` -- align on a key and overwrite a cell only with a
  non-null new value; unknown keys and new columns are ignored.
* ``upsert`` -- changed rows replace, untouched rows stay, new rows append
  (anti-join + union: no full outer join, no per-column coalesce).
* ``digest_news`` / ``digest_counts`` -- the ``published_at BETWEEN start AND
  end`` range join as an equi-join on stretches of 2^k days, so neither a
  nested-loop join nor a row per day is planned; counts are pre-aggregated per
  day before any join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def masked_update(base: DataFrame, updates: DataFrame, key: str = "id", order: str | None = None,
                  unique: bool = False) -> DataFrame:
    """``base`` with each shared column replaced by ``coalesce(new, old)``.

    Several updates of one key are one: of each column the non-null value of the
    latest row by ``order`` (a column of ``updates``), or without it the greatest
    one; the row isn't doubled. ``unique`` says that no key has two, which spares the
    grouping."""
    shared = [c for c in updates.columns if c not in (key, order) and c in base.columns]
    if unique:
        u = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in shared])
    else:
        new = lambda c: F.max(c) if order is None else F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order)))
        u = updates.groupBy(key).agg(*[new(c).alias(f"_new_{c}") for c in shared])
    joined = base.join(u, key, "left")
    return joined.select(*[
        F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in shared else F.col(c)
        for c in base.columns])


def upsert(base: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``changes`` replace rows of ``base`` with the same key; new keys
    are appended; other base rows are kept as they are."""
    kept = base.join(changes.select(key), key, "left_anti")
    return changes.select(*base.columns).unionByName(kept)


def attach_content(listing: DataFrame, pages: DataFrame, on: str = "url", content_col: str = "content",
                   default: str = "", flag_col: str | None = None) -> DataFrame:
    """Left join of listing rows to fetched page text; missing -> default.
    ``flag_col`` tells whether there was a page. A page that was fetched more than
    once is one page (with its greatest text), so no listing row is doubled."""
    p = pages.groupBy(on).agg(F.max(content_col).alias("_fetched"), F.lit(True).alias("_there"))
    out = (listing.join(p, on, "left")
           .withColumn(content_col, F.coalesce(F.col("_fetched"), F.lit(default))))
    if flag_col:
        out = out.withColumn(flag_col, F.coalesce(F.col("_there"), F.lit(False)))
    return out.drop("_fetched", "_there")


#: Parts that the articles of a day, and of each longer stretch, are dealt into.
DAY_PARTS = 8
#: Levels of stretches: 2^k days, enough for every date there is.
LEVELS = 23


def day_number(day: F.Column) -> F.Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long")


def _shift(value: F.Column, k: F.Column) -> F.Column:
    return F.call_function("shiftright", value, k)


def stretches(first: F.Column, last: F.Column) -> F.Column:
    """The days from ``first`` to ``last`` as aligned stretches ``level, at`` (days
    ``at * 2^level`` to ``(at + 1) * 2^level - 1``), two a level at most; none if the range is
    reversed."""
    a, b = day_number(first), day_number(last) + 1

    def of(k: F.Column) -> F.Column:
        left, right = -_shift(-a, k), _shift(b, k)   # rounded up and down
        piece = lambda at, there: F.when((left < right) & there, F.struct(k.alias("level"), at.alias("at")))
        return F.array(piece(left, left.bitwiseAND(1) == 1), piece(right - 1, right.bitwiseAND(1) == 1))

    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), of)), lambda p: p.isNotNull())


def _pieces(digest: DataFrame) -> DataFrame:
    """One row per digest and stretch of its days: some for a week, some dozens for a
    thousand years."""
    return digest.select("id", "start_date", "end_date", F.explode(stretches(F.col("start_date"), F.col("end_date"))).alias("_p")).select(
        "id", "start_date", "end_date", F.col("_p.level").alias("level"), F.col("_p.at").alias("at"))


def _levels(pieces: DataFrame) -> F.Column:
    """The levels that occur, as one value."""
    return F.coalesce(pieces.agg(F.sort_array(F.collect_set("level"))).scalar(), F.array().cast("array<int>"))


def digest_news(digest: DataFrame, news: DataFrame, inclusive_end_day: bool = False,
                public_only: bool = True) -> DataFrame:
    """Pairs (digest, article) with ``start <= published_at <= end`` (public
    articles only by default).

    Literal semantics compare against the end date at midnight, so of the last
    day only articles published exactly at 00:00 qualify;
    ``inclusive_end_day`` takes the whole last day.

    A digest is a few stretches of 2^k days (not a row a day), and an article joins
    by the stretch it lies in on each level that some digest has. The articles of
    a stretch are dealt into ``DAY_PARTS`` parts, so a busy day isn't one task."""
    pieces = _pieces(digest).withColumnRenamed("id", "digest_id")
    n = news.where(F.col("is_public")) if public_only else news
    day = day_number(F.to_date("published_at"))
    n = n.select("*", _levels(pieces).alias("_levels")).select("*", F.explode("_levels").alias("_level"))
    n = n.select(*news.columns, "_level", _shift(day, F.col("_level")).alias("_place"),
                 F.pmod(F.xxhash64("published_at", *(["id"] if "id" in news.columns else [])), F.lit(DAY_PARTS)).alias("_part"))
    p = pieces.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(DAY_PARTS - 1).cast("long"))).alias("part"))
    joined = n.join(p, (n["_level"] == p["level"]) & (n["_place"] == p["at"]) & (n["_part"] == p["part"]))
    start_ts = F.col("start_date").cast("timestamp_ntz")
    end_ts = (F.date_add("end_date", 1).cast("timestamp_ntz") - F.expr("INTERVAL 1 MICROSECOND")
              if inclusive_end_day else F.col("end_date").cast("timestamp_ntz"))
    return (joined.where(F.col("published_at").between(start_ts, end_ts))
            .drop("_level", "_place", "_part", "level", "at", "part", "start_date", "end_date"))


def digest_counts(digest: DataFrame, news: DataFrame, inclusive_end_day: bool = False) -> DataFrame:
    """Number of public articles per digest (0 kept), from one count a day and
    from these one a stretch; of the last day the articles exactly at its midnight,
    or all."""
    ranges = digest.where(F.col("start_date") <= F.col("end_date"))
    per_day = (news.where(F.col("is_public")).groupBy(F.to_date("published_at").alias("day"))
               .agg(F.count(F.lit(1)).alias("n_all"),
                    F.count_if(F.col("published_at") == F.to_date("published_at").cast("timestamp_ntz")).alias("n_midnight")))
    # the days before the last one
    pieces = _pieces(ranges.withColumn("end_date", F.date_add("end_date", -1)))
    day = day_number(F.col("day"))
    at_levels = per_day.select("day", "n_all", _levels(pieces).alias("_levels")).select(
        "day", "n_all", F.explode("_levels").alias("level"))
    per_stretch = at_levels.groupBy("level", _shift(day, F.col("level")).alias("at")).agg(F.sum("n_all").alias("n"))
    before = pieces.join(per_stretch, ["level", "at"]).select("id", "n")
    last = ranges.select("id", F.col("end_date").alias("day")).join(per_day, "day").select(
        "id", (F.col("n_all") if inclusive_end_day else F.col("n_midnight")).alias("n"))
    totals = before.unionByName(last).groupBy("id").agg(F.sum("n").cast("long").alias("news_count"))
    return digest.join(totals, "id", "left").select(
        "id", "start_date", "end_date", "is_public",
        F.coalesce(F.col("news_count"), F.lit(0)).cast("long").alias("news_count"))
