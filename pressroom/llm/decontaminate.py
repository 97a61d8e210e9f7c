"""Benchmark decontamination as a prefix-filtered set join.

Items and documents are word sequences (``common.words``). An item's windows are
its runs of ``window`` words; an item of fewer words is one window. A document
word inside any exact occurrence of a window is a hit.

1. A window is the set of its word shingles (``shingle`` words; a shorter window
   is one shingle). One pass over the documents finds where item shingles occur
   (an equi-join on the hash, checked on the words), a row for each place.
2. These places give each shingle's frequency, and shingles are ordered by it. A
   window holding one that never occurs can't occur; of the others only the rarest
   shingle's places are joined with the window: containment of the whole window
   needs that one, so a prefix of one token is enough.
3. A joined place fixes where in the document the window would begin. The length
   bound asks that the document has room for it before that place.
4. At this alignment each shingle of the window is looked up at the one place where
   it must stand (positional bound). Windows whose shingles all do are exact
   occurrences, as consecutive shingles overlap in all but one word.

A phrase of many items and many documents is no row per pair of them: it is joined
only where it is a window's rarest shingle, and equal windows of several items are
one. Only DataFrame functions run. Item tables are broadcast by Catalyst below the
session's threshold and shuffled beyond it. Documents are keyed by a digest of
id and text, so neither a repeated id nor a null id mixes rows.

Null and word-less texts have no words and no hits; word-less items and items
with a null id are left out; repeated items count once per item_id; repeated
documents keep a row each; extra columns are ignored; empty tables give no rows
(documents) or no hits (items).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressroom.llm.common import GAP, LOWER, UPPER, free_name, materialize, read, words

WINDOW = 10
SHINGLE = 5


def _key(id_col: str, text_col: str):
    return F.md5(F.concat_ws("\0", F.coalesce(F.col(id_col).cast("string"), F.lit("\1")),
                             F.coalesce(F.col(text_col), F.lit(""))))


def _shingles(rows: DataFrame, size: int, keep: list[str]) -> DataFrame:
    """``keep, pos, shingle``-parts ``w0..`` of every run of ``size`` words of ``rows(words)``."""
    shifted = [F.col("words")] + [F.slice("words", k + 1, F.greatest(F.size("words") - k, F.lit(0)))
                                  for k in range(1, size)]
    zipped = F.slice(F.arrays_zip(*[c.alias(f"w{k}") for k, c in enumerate(shifted)]), 1,
                     F.greatest(F.size("words") - (size - 1), F.lit(0)))
    parts = [F.col(f"s.w{k}") for k in range(size)]
    return (rows.select(*keep, "words").select(*keep, F.posexplode(zipped).alias("pos", "s"))
            .select(*keep, "pos", F.xxhash64(*parts).alias("hash"), F.concat_ws(" ", *parts).alias("shingle")))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """``item, words, n, len, g``: distinct items with words, window length and shingle size."""
    return (items.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("words"))
            .where(F.size("words") > 0).distinct()
            .withColumn("item", F.md5(F.concat_ws(" ", "item_id", F.array_join("words", " "))))
            .withColumn("n", F.size("words")).withColumn("len", F.least("n", F.lit(window)))
            .withColumn("g", F.least("n", F.lit(shingle))))


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
               shingle: int = SHINGLE) -> DataFrame:
    """``key, item_id, start, len``: every occurrence of every window, ``key``
    being the digest of a document's id and text."""
    shingle = min(shingle, window)
    known = materialize(item_windows(items, item_col, item_text, window, shingle), "items")
    sizes = sorted(r["g"] for r in known.select("g").distinct().collect())  # at most ``shingle`` values
    texts = docs.select(_key(id_col, text_col).alias("key"), words(F.col(text_col)).alias("words"))
    own = found = None
    for g in sizes:
        mine = _shingles(known.where(F.col("g") == g), g, ["item", "g", "n", "len"])
        own = mine if own is None else own.unionByName(mine)
        wanted = mine.select("hash", F.col("shingle").alias("wanted")).distinct()
        at = (_shingles(texts, g, ["key"]).join(wanted, "hash").where("shingle = wanted")
              .select("key", "pos", "shingle", F.lit(g).alias("g")))
        found = at if found is None else found.unionByName(at)
    if own is None:
        return docs.sparkSession.createDataFrame([], "key string, item_id string, start int, len int")
    found = materialize(found.distinct(), "occurrences")
    counts = found.groupBy("g", "shingle").agg(F.count(F.lit(1)).alias("n_found"))

    # the rarest shingle of each window, which begins at most len - g words before it
    ranked = (own.join(counts, ["g", "shingle"], "left").select(
        "item", "g", "len", F.struct(F.coalesce("n_found", F.lit(0)).alias("n_found"), "shingle", F.col("pos").alias("at")).alias("r"),
        F.explode(F.sequence(F.greatest(F.col("pos") - F.col("len") + F.col("g"), F.lit(0)),
                             F.least("pos", F.col("n") - F.col("len")))).alias("begin"))
        .groupBy("item", "g", "len", "begin").agg(F.min("r").alias("r")).where("r.n_found > 0"))
    windows = known.select("item", "item_id", "words").join(ranked, "item").select(
        "g", "item_id", "len", F.col("r.shingle").alias("shingle"), (F.col("r.at") - F.col("begin")).alias("before"),
        F.slice("words", F.col("begin") + 1, F.col("len")).alias("words"))
    windows = materialize(windows.groupBy("g", "shingle", "len", "before", "words").agg(
        F.collect_set("item_id").alias("items")).withColumn("win", F.md5(F.array_join("words", " "))), "windows")

    aligned = materialize(
        found.join(windows.select("g", "shingle", "before", "win"), ["g", "shingle"])
        .select("key", "g", "win", (F.col("pos") - F.col("before")).alias("start")).where("start >= 0").distinct(), "aligned")
    parts = windows.select("win", "g", "len", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.col("len") - F.col("g") + 1),
        lambda i: F.array_join(F.slice("words", i, F.col("g")), " "))).alias("step", "shingle"))
    whole = (aligned.join(parts, ["win", "g"]).withColumn("pos", F.col("start") + F.col("step"))
             .join(found, ["key", "g", "pos", "shingle"])
             .groupBy("key", "g", "len", "win", "start").agg(F.count(F.lit(1)).alias("n_found"))
             .where("n_found = len - g + 1"))
    return whole.join(windows.select("win", "items"), "win").select(
        "key", F.explode("items").alias("item_id"), "start", "len")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  keep: list[str] | None = None, **options) -> DataFrame:
    """Per document its ``keep`` columns (the id by default), ``n_words, n_hit,
    n_items, items, spans, contaminated``; ``items`` are the sorted ids,
    ``spans`` the (start, len) of every window found."""
    hits = find_items(docs, items, id_col, text_col, **options)
    spans = hits.groupBy("key").agg(F.collect_set(F.struct("start", "len")).alias("_spans"),
                                    F.array_sort(F.collect_set("item_id")).alias("_items"))
    keep = [id_col] if keep is None else keep
    rows = docs.select(*[F.col(c) for c in keep], _key(id_col, text_col).alias("_key"),
                       F.size(words(F.col(text_col))).cast("long").alias("_n"))
    covered = F.array_distinct(F.flatten(F.transform(
        "_spans", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))))
    none = F.array().cast("array<string>")
    return (rows.join(spans, rows["_key"] == spans["key"], "left")
            .select(*keep, F.col("_n").alias("n_words"),
                    F.coalesce(F.when(F.col("_spans").isNotNull(), F.size(covered)), F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("_items", none).alias("items"), F.col("_spans").alias("spans"))
            .withColumn("n_items", F.size("items").cast("long"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    **options) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs."""
    name = free_name(docs, "document")
    hit = find_items(docs, items, id_col, text_col, **options).select(F.col("key").alias(name)).distinct()
    return docs.withColumn(name, _key(id_col, text_col)).join(hit, name, "left_anti").select(docs.columns)


def op2_decontaminate(spark, sf_dir):
    out = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def words_sql(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), "
            f"'{GAP.replace('[', '[^', 1)}')")


ORACLE = f"""
WITH it AS (SELECT DISTINCT cast(item_id AS VARCHAR) AS item_id, {words_sql('text')} AS w FROM benchmark WHERE item_id IS NOT NULL),
wins AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS l, array_to_string(list_slice(w, b + 1, b + least(len(w), {WINDOW})), ' ') AS win
         FROM (SELECT *, unnest(range(0, len(w) - least(len(w), {WINDOW}) + 1)) AS b FROM it WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS rn, doc_id, {words_sql('text')} AS w FROM documents),
dw AS (SELECT rn, l, s, array_to_string(list_slice(w, s + 1, s + l), ' ') AS win
       FROM (SELECT rn, w, l, unnest(range(0, len(w) - l + 1)) AS s FROM d, (SELECT DISTINCT l FROM wins) WHERE len(w) >= l)),
hit AS (SELECT dw.rn, wins.item_id, dw.s, dw.l FROM dw JOIN wins ON dw.l = wins.l AND dw.win = wins.win),
pos AS (SELECT rn, count(DISTINCT p) AS n_hit FROM (SELECT rn, unnest(range(s, s + l)) AS p FROM hit) GROUP BY rn),
ids AS (SELECT rn, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT rn, item_id FROM hit) GROUP BY rn)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rn) LEFT JOIN ids USING (rn)
"""
