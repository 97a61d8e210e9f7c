"""Operators on documents against brute-force versions and on odd rows."""
import hashlib
import random
import tracemalloc
import zlib
from collections import Counter
from math import log2

import numpy as np
import pandas as pd
import pytest
import re

from pressroom.llm import (decontaminate, jaccard_join as jj, lm_score, neighbours, quality, range_coder as rc,
                           substring_dedup as sd, suffix_sort, token_files as tf)
from pressroom.llm.common import LOWER, UPPER
from pressroom.llm.graph import components
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(str.maketrans(UPPER, LOWER)))


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- decontamination

def brute_hits(text, items, window=10):
    w, hit, ids = words(text), set(), set()
    for item, t in items:
        x = words(t)
        if item is None or not x:
            continue
        size = min(window, len(x))
        for b in range(len(x) - size + 1):
            for s in range(len(w) - size + 1):
                if w[s:s + size] == x[b:b + size]:
                    hit.update(range(s, s + size))
                    ids.add(str(item))
    return len(w), len(hit), sorted(ids)


def test_decontamination_brute_force(spark, docs_of, odd_rows):
    rng = random.Random(5)
    vocab = [f"v{k}" for k in range(9)] + ["É", "ß"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [("i1", say(25)), ("i2", say(10)), ("i3", "v1 V2."), ("i4", "v3"), ("i5", say(4)), ("i5", say(12)), (None, say(30)),
             ("i6", None), ("i7", "!!"), ("i8", "")]
    items.append(("i9", items[0][1]))
    some = [t.translate(str.maketrans(LOWER, UPPER)) for _, t in items if t]
    rows = [(k, f"{say(rng.randint(0, 40))} {rng.choice(some)}; {say(3)}" if k % 2 else say(30)) for k in range(20)]
    rows += [(i, t if t is None or len(t) < 9000 else t[:3000]) for i, t in odd_rows]
    bench = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id string, text string, key int")
    docs = docs_of(rows)
    got = [tuple(r) for r in decontaminate.contamination(docs, bench).select("doc_id", "n_words", "n_hit", "items").collect()]
    want = [(i, *brute_hits(t, items)) for i, t in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    clean = decontaminate.clean_documents(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(w[2] == 0 for w in want)
    assert decontaminate.contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def test_a_common_phrase_is_not_joined_with_every_item(spark, docs_of, monkeypatch):
    """A phrase of all items and all documents is no window's rarest shingle."""
    phrase, seen = "one phrase that stands in everything here", {}
    keep = decontaminate.materialize
    monkeypatch.setattr(decontaminate, "materialize", lambda df, name: seen.setdefault(name, keep(df, name)))
    bench = spark.createDataFrame([(f"i{k}", f"a{k} b{k} {phrase} c{k} d{k}") for k in range(60)], "item_id string, text string")
    docs = docs_of([(k, f"x{k} {phrase} y{k}") for k in range(200)] + [(900, f"z a7 b7 {phrase} c7 d7"), (901, phrase)])
    found = decontaminate.contamination(docs, bench).where("contaminated").collect()
    assert [(r.doc_id, r["items"], r.n_hit) for r in found] == [(900, ["i7"], 11)]
    assert seen["aligned"].count() <= 4


# ---- quality

def test_quality_held_out(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    out = quality.op3_quality(spark, sf_dir).toPandas().merge(table(spark, sf_dir, "labels").toPandas(), on="doc_id")
    held = out[out.held_out]
    assert (held.held_out == (held.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4) == 2)).all()
    assert ((out.predicted == (out.score >= quality.THRESHOLD)) & out.score.between(0, 1)).all()
    assert (held.predicted == held.quality).mean() > 0.95


def test_quality_odd_rows(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows)
    labels = spark.createDataFrame([(k, k % 2, 0, 1) for k in range(10)] + [(3, None, 0, 1), (None, 1, 0, 1), (3, 1, 0, 1)],
                                   "doc_id long, quality int, toxic int, stats int")
    out = quality.classify_quality(docs, labels)
    assert out.count() == len(odd_rows) and out.where("score IS NULL OR held_out IS NULL").count() == 0
    for few in (labels.limit(0), labels.where("quality = 1")):
        scores = {r.score for r in quality.classify_quality(docs, few).collect()}
        assert scores == ({0.5} if few.count() == 0 else {1.0})
    assert quality.classify_quality(docs.limit(0), labels).count() == 0


def test_quality_equals_a_plain_fit(spark, docs_of):
    rng = random.Random(21)
    good, bad = ["the", "quick", "river", "stone", "light"], ["buy!!", "$$$", "1234", "click", "x"]
    rows = [(BIG + k, " ".join(rng.choice(good if rng.random() < (0.9 if k % 2 else 0.2) else bad) for _ in range(rng.randint(3, 60))))
            for k in range(240)] + [(None, "no id"), (7, ""), (8, None), (9, "same"), (9, "same")]
    labels = spark.createDataFrame([(i, k % 2) for k, (i, _) in enumerate(rows[:240])] + [(7, 0), (9, 1)], "doc_id long, quality int")
    got = quality.classify_quality(docs_of(rows), labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    label = {r.doc_id: r.quality for r in labels.collect()}
    fold = lambda i: zlib.crc32(str(i).encode()) % 4
    stats = np.array([quality.stats_of(t or "", quality._char_table()) for _, t in rows])
    known = [k for k, (i, _) in enumerate(rows) if i in label and fold(i) != 2]
    part, rest = ([k for k in known if (fold(rows[k][0]) == 3) == last] for last in (False, True))
    y = np.array([label.get(i, 0) for i, _ in rows], float)
    model = quality.Model(stats[part].mean(0), stats[part].std(0), quality.FEATURES, quality.SEED)
    z = np.clip((stats - model.mean) / model.std, -8, 8) @ model.omega + model.phase
    z = np.hstack([np.cos(z) * np.sqrt(2 / quality.FEATURES), np.ones((len(z), 1))])
    a = z[part]
    width = a.shape[1]
    raw = z @ np.linalg.solve(a.T @ a + quality.RIDGE * len(part) * np.eye(width) / width, a.T @ y[part])
    # isotonic regression of the binned scores by its min-max formula
    at = np.clip(((raw[rest] - quality.LOW) / (quality.HIGH - quality.LOW) * quality.BINS).astype(int), 0, quality.BINS - 1)
    n, k = np.bincount(at, minlength=quality.BINS), np.bincount(at, y[rest], minlength=quality.BINS)
    x = quality.LOW + (np.arange(quality.BINS) + 0.5) * (quality.HIGH - quality.LOW) / quality.BINS
    full = np.flatnonzero(n)
    fit = [max(min(k[full[p:q + 1]].sum() / n[full[p:q + 1]].sum() for q in range(i, len(full))) for p in range(i + 1))
           for i in range(len(full))]
    levels = sorted(set(np.round(fit, 12)))
    block = [full[[round(f, 12) == v for f in fit]] for v in levels]
    xs = [np.average(x[b], weights=n[b]) for b in block]
    want = {i: s for (i, _), s in zip(rows, np.clip(np.interp(raw, xs, levels), 0, 1))}
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-6) and r.predicted == int(r.score >= quality.THRESHOLD)
        assert r.held_out == (r.doc_id is not None and fold(r.doc_id) == 2)
    assert len({round(s, 6) for s in want.values()}) > 10


# ids that only whole numbers hold, beside a null
BIG = 2**53 + 1
IDS = [BIG, BIG + 2, None, BIG + 4, 0, -5, None]


def test_ids_beside_nulls_stay_exact(spark, docs_of, tmp_path):
    shared = "a passage of more than fifty bytes that several documents have in common"
    docs = docs_of([(i, f"{shared} {k}") for k, i in enumerate(IDS)]).coalesce(1)
    labels = spark.createDataFrame([(BIG, 1), (BIG + 2, 0)], "doc_id long, quality int")
    want = Counter(IDS)
    ids = lambda frame, c="doc_id": Counter(r[c] for r in frame.collect())
    assert ids(quality.classify_quality(docs, labels)) == want
    assert ids(lm_score.score_documents(docs, labels)) == want
    assert ids(tf.read_tokens(spark, tf.write_tokens(docs, str(tmp_path / "t")))) == want
    stripped = sd.remove_repeats(docs)
    assert ids(stripped) == want
    # the smallest id keeps the passage; documents without an id keep theirs
    assert sorted(str(r.doc_id) for r in stripped.collect() if not r.removed) == ["-5", "None", "None"]


def test_caller_columns_stay_as_they_are(spark, docs_of):
    from pressroom.llm import mixing

    rows = [(k, f"one two three four five six seven eight nine ten {k}") for k in range(20)] + [(None, "x"), (3, "another")]
    docs, items = docs_of(rows), spark.createDataFrame([("i", "never seen words of an item that is not here at all")], "item_id string, text string")
    clash = ["several", "document", "begin", "text_key", "__several", "__document", "__begin", "__text_key", "__doc_key"]
    own = {r.key: [r[c] for c in clash] for r in docs.collect()}
    for out in (mixing.mix_sources(docs, budget=60), decontaminate.clean_documents(docs, items), jj.one_of_each_group(docs)):
        found = out.collect()
        assert found and all([r[c] for c in clash] == own[r.key] for r in found)


def test_threshold_below_the_candidates_is_an_error(spark, docs_of):
    with pytest.raises(ValueError):
        jj.jaccard_groups(docs_of([(1, "a b c d e f")]), threshold=0.4)


def test_isotonic():
    x, y = quality.isotonic(np.array([2, 2, 0, 2, 2]), np.array([1, 0, 0, 1, 2]), np.arange(5.0))
    assert list(y) == [0.25, 0.5, 1.0] and list(x) == [0.5, 3.0, 4.0]


# ---- language models

def brute_losses(rows, targets, prior=lm_score.PRIOR):
    """(tokens, target loss, background loss) of every row."""
    grams = [list(zip(["", *words(t)], [*words(t), ""])) for _, t in rows]
    pairs, singles = [Counter(), Counter()], [Counter(), Counter()]
    for (i, _), own in zip(rows, grams):
        for kind in (0, 1) if i is not None and i in targets else (0,):
            pairs[kind].update(own)
            singles[kind].update(w for _, w in own)
    sizes = [sum(c.values()) for c in singles]
    share = [sizes[1] / sizes[0], 1.0]

    def loss(kind, v, w):
        s, base = share[kind], singles[0][w] / sizes[0]
        one = (s * singles[kind][w] + prior * base) / (s * sizes[kind] + prior)
        return -log2((s * pairs[kind][v, w] + prior * one) / (s * singles[kind][v] + prior))

    return [(len(g), *(sum(loss(k, *x) for x in g) / len(g) for k in (1, 0))) for g in grams]


@pytest.mark.parametrize("chunk", [7, lm_score.CHUNK_TOKENS])
def test_lm_brute_force(spark, docs_of, odd_rows, monkeypatch, chunk):
    monkeypatch.setattr(lm_score, "CHUNK_TOKENS", chunk)
    rows = [(0, "a b a B"), (1, "a b. c"), (2, None), (3, ""), (4, "éa b\0 c"), (5, "a b c"), (None, "z z"), (6, "q " * 300),
            (7, "the cat sat on the mat"), (8, "The dog sat, on a log!")] + [(i if i is None else 100 + i, t) for i, t in odd_rows]
    targets = [0, 1, 3, 1, None, 7, 777]
    df = spark.createDataFrame([(i, 0) for i in targets], "doc_id long, target int")
    out = lm_score.score_documents(docs_of(rows), df)
    assert out.columns == ["doc_id", "n_tokens", "target_loss", "background_loss", "score"]
    order = lambda x: (str(x[0]), x[1], x[2])
    got = sorted(map(tuple, out.collect()), key=order)
    want = sorted(((i, *x, x[1] - x[2]) for (i, _), x in zip(rows, brute_losses(rows, targets))), key=order)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2:] == pytest.approx(w[2:], abs=1e-9)
    if chunk > 7:
        assert lm_score.score_documents(docs_of(rows).limit(0), df).count() == 0
        none = lm_score.score_documents(docs_of(rows), df.limit(0)).collect()
        assert len(none) == len(rows) and all(r.score == 0 for r in none)


def test_lm_tells_topics_of_one_language_apart(spark, docs_of):
    """Same letters, other words: documents like the target's score lower."""
    rng = random.Random(4)
    sea, land = ["reef", "tide", "boat", "wave", "gull"], ["barn", "field", "plough", "sheep", "gate"]
    say = lambda own: " ".join(rng.choice(own + ["the", "and", "of"] * 2) for _ in range(60))
    docs = docs_of([(k, say(sea if k % 2 else land)) for k in range(80)])
    target = spark.createDataFrame([(k,) for k in range(1, 20, 2)], "doc_id long")
    score = {r.doc_id: r.score for r in lm_score.score_documents(docs, target).collect()}
    assert max(score[k] for k in range(21, 80, 2)) < min(score[k] for k in range(0, 80, 2))


# ---- repeated substrings

def brute_strip(rows, length=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            if i is not None:
                first[b[p:p + length]] = min(first.get(b[p:p + length], i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if i is not None and first[b[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        out.append((i, len(b), bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("hot", [sd.HOT_CHUNKS, 1])
def test_substrings_brute_force(spark, docs_of, odd_rows, hot):
    rng = random.Random(7)
    base = [" ".join(rng.choice(["la", "é", "foo", "ba", "x"]) + str(rng.randint(0, 9)) for _ in range(120)) for _ in range(6)]
    rows = []
    for k in range(60):
        a, b = rng.choice(base), rng.choice(base)
        i, j = sorted(rng.sample(range(len(a)), 2))
        rows.append((100 + k, a[i:j] + rng.choice(["", "#", " "]) + b[:rng.randint(0, 200)]))
    rows += [(300, "ab" * 400), (301, "ab" * 300 + "c"), (302, "b" * 49), (303, "b" * 50), (304, "b" * 51)]
    rows += [(i, t if t is None or len(t) < 9000 else t[:3000]) for i, t in odd_rows]
    got = sd.remove_repeats(docs_of(rows), hot_chunks=hot).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_bytes, bytes(r.kept)) for r in got))) == sorted(map(repr, brute_strip(rows)))
    for r in got:
        assert sum(x.end - x.start for x in r.removed) == r.n_bytes - len(r.kept)
    assert sd.remove_repeats(docs_of(rows).limit(0)).count() == 0


def repeats_in_process(rows, chunks, buckets, hot):
    """The steps of ``remove_repeats`` on plain frames: the bytes of each bucket, the chunks and their marks."""
    def by(column, frames):
        every = pd.concat(frames)
        return [(k, f) for k, f in every.groupby(column)]

    table = pd.DataFrame([(k % chunks, i or 0, i is not None, (t or "").encode()) for k, (i, t) in enumerate(rows)],
                         columns=["chunk", "doc_id", "known", "text"])
    own = {k: f for k, f in table.groupby("chunk")}
    keys = [sd._frame(sd.send_keys(k, sd.Chunk(f), buckets)) for k, f in own.items()]
    seen = dict(by("chunk", [sd.answer_keys(f, hot) for _, f in by("bucket", keys)]))
    pieces = [sd._frame(sd.send_pieces(k, sd.Chunk(f), seen[k], buckets)) for k, f in own.items()]
    first = by("chunk", [sd.answer_pieces(f) for _, f in by("bucket", pieces)])
    answers = {k: pd.concat([seen[k], *(f for c, f in first if c == k)]) for k in own}
    marks = pd.concat([sd._frame(sd.mark_pieces(k, sd.Chunk(f), answers[k], buckets)) for k, f in own.items()])
    sent = [f for _, f in by("bucket", [marks[marks["kind"] == sd.BYTES]])]
    return sent, own, marks[marks["kind"] != sd.BYTES]


def lines_between(rng, lines, texts, rows):
    """Texts of lines that recur, each before words of its own."""
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    common = [word(70) for _ in range(lines)]
    return [(k, "".join(rng.choice(common) + word(30) for _ in range(rows))) for k in range(texts)]


@pytest.mark.parametrize("hot, pieces", [(sd.HOT_CHUNKS, sd.HOT_PIECES), (sd.HOT_CHUNKS, 3), (1, sd.HOT_PIECES)])
def test_substrings_sorted_in_batches(monkeypatch, hot, pieces):
    monkeypatch.setattr(sd, "SORT_STRINGS", 50)
    monkeypatch.setattr(sd, "HOT_PIECES", pieces)
    rows = lines_between(random.Random(3), 9, 40, 8)
    rows += [(2**53 + 1, rows[3][1] + "!"), (2**53 + 3, rows[3][1] + "!"), (-(2**63), rows[5][1][:200]), (None, rows[3][1]),
             (7, rows[3][1]), (90, "ab" * 400), (91, "ab" * 300 + "c"), (92, None), (93, "\0" * 120), (94, "\0" * 90 + "d")]
    sent, own, marks = repeats_in_process(rows, 5, 3, hot)
    marks = pd.concat([marks, *map(sd.sort_suffixes, sent)])
    got = pd.concat([sd.strip(sd._ordered(f), marks[marks["chunk"] == k]) for k, f in own.items()])
    got = [(i if known else None, n, kept) for i, known, n, kept in zip(got["doc_id"], got["known"], got["n_bytes"], got["kept"])]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_strip(rows)))


def peak_of(run):
    tracemalloc.start()
    try:
        kept = run()
        return tracemalloc.get_traced_memory(), kept
    finally:
        tracemalloc.stop()


def test_substrings_memory_of_a_chunk():
    rng = random.Random(5)
    texts = [bytes(rng.choices(b"abcdefghijklmnopqrstuvwxyz ", k=20_000)) for _ in range(200)]
    frame = pd.DataFrame({"doc_id": range(200), "known": True, "text": texts})
    (held, _), chunk = peak_of(lambda: sd.Chunk(frame))
    assert len(chunk.keys) and held < 6 * 4_000_000


def test_substrings_memory_of_a_bucket(monkeypatch):
    monkeypatch.setattr(sd, "SORT_STRINGS", 20_000, raising=False)
    sent, _, _ = repeats_in_process(lines_between(random.Random(6), 300, 20, 200), 2, 1, sd.HOT_CHUNKS)
    (_, peak), out = peak_of(lambda: sd.sort_suffixes(sent[0]))
    assert len(out) and peak < 20 * 400_000


def test_substrings_chunks_follow_the_bytes(monkeypatch, spark, docs_of):
    # a session's shuffle partitions say nothing about how much a worker can hold
    monkeypatch.setattr(sd, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(sd, "BUCKET_BYTES", 2000)
    rows = lines_between(random.Random(8), 5, 30, 10) + [(None, None), (40, "")]
    docs = docs_of(rows)
    assert sd.dealt(docs, "text") == (30, 15)
    assert sd.dealt(docs.limit(0), "text") == (8, 8)
    got = sd.remove_repeats(docs).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_bytes, bytes(r.kept)) for r in got))) == sorted(map(repr, brute_strip(rows)))


def test_deep_shallow_order():
    rng = random.Random(2)
    for letters in (b"a", b"ab", b"abcdefgh"):
        data = bytes(rng.choice(letters) for _ in range(3000))
        data = data + data[500:900] + data + bytes(8)
        at = np.array([rng.randrange(len(data) - 58) for _ in range(6000)])
        order, classes = suffix_sort.sort_strings(data, at, 50)
        texts = [data[a:a + 50] for a in at[order]]
        assert texts == sorted(texts)
        assert classes[-1] + 1 == len(set(texts)) == len(set(zip(classes.tolist(), texts)))


# ---- Jaccard join

def brute_groups(rows, t=0.8):
    sets = []
    for i, text in rows:
        w = words(text)
        k = min(5, len(w))
        sets.append(frozenset(tuple(w[a:a + k]) for a in range(len(w) - k + 1)) if w and i is not None else None)
    copy = {}
    for (i, _), s in zip(rows, sets):
        if s:
            copy[s] = min(copy.get(s, i), i)
    kinds = list(copy)
    up = list(range(len(kinds)))
    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    links = Counter()
    for a in range(len(kinds)):
        for b in range(a):
            if len(kinds[a] & kinds[b]) >= t * len(kinds[a] | kinds[b]) - 1e-12:
                links[a] += 1
                links[b] += 1
                up[root(a)] = root(b)
    least = {}
    for k, s in enumerate(kinds):
        least[root(k)] = min(least.get(root(k), copy[s]), copy[s])
    out = []
    for (i, _), s in zip(rows, sets):
        if i is not None:
            out.append((i, least[root(kinds.index(s))], links[kinds.index(s)], copy[s]) if s else (i, i, 0, i))
    return out


@pytest.mark.parametrize("block", [jj.BLOCK, 7])
def test_jaccard_brute_force(spark, docs_of, odd_rows, block, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK", block)
    rng = random.Random(4)
    base = [[f"w{rng.randrange(400)}" for _ in range(80)] for _ in range(5)]
    rows = []
    for k in range(90):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
        rows.append((1000 - k, " ".join(w)))
    rows += [(i, t if t is None or len(t) < 9000 else t[:3000]) for i, t in odd_rows]
    docs = docs_of(rows)
    got = jj.jaccard_groups(docs).select("doc_id", "class_id", "n_links", "copy_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute_groups(rows))
    kept = jj.one_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    want = {c for (_, c, _, _), (i, t) in zip(brute_groups(rows), [r for r in rows if r[0] is not None]) if words(t)}
    assert want <= set(ids) and ids.count(9) == 1 and ids.count(None) == 2 and 22 not in ids
    assert jj.jaccard_groups(docs.limit(0)).count() == 0


def test_jaccard_first_shared_band(spark):
    # band k - 1 agrees in its low bytes but not in its hashes; band k is the only one that is shared
    rng, rows = np.random.default_rng(8), []
    for k in range(1, jj.BANDS):
        a = rng.integers(0, 1 << 32, (jj.BANDS, jj.ROWS), dtype=np.uint32)
        b = a.copy()
        b[:, 0] += 1
        b[k] = a[k]
        b[k - 1, 0] = a[k - 1, 0] ^ np.uint32(1 << 20)
        rows += [(2 * k, bytearray(a.astype("<u4").tobytes())), (2 * k + 1, bytearray(b.astype("<u4").tobytes()))]
    edges = jj.candidate_edges(spark.createDataFrame(rows, "cls long, hashes binary")).collect()
    assert {(min(e), max(e)) for e in edges} == {(2 * k, 2 * k + 1) for k in range(1, jj.BANDS)}


def test_components(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(5, 9), (9, 7), (7, 7), (200, 5), (300, 300)] + [(1000, k) for k in range(400, 500)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 141)}, **{k: 5 for k in (5, 7, 9, 200)}, **{k: 400 for k in [*range(400, 500), 1000]}}


# ---- token files

def test_token_files_round_trip(spark, docs_of, odd_rows, tmp_path):
    from tokenizers import Tokenizer

    rows = odd_rows + [(40, "a<|endoftext|>b"), (41, "don't stop  now \n\n x")]
    path = str(tmp_path / "tokens")
    tf.write_tokens(docs_of(rows), path, shards=3)
    got = tf.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    lib = Tokenizer.from_file(tf.default_tokenizer())
    want = [(i, lib.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]
    none_first = lambda i: (i is not None, i)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=none_first)
    assert sorted(map(repr, ((r.doc_id, r.ids) for r in got))) == sorted(map(repr, want))
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    assert tf.token_table(docs_of(rows).limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 63, 65, 4097, 300_001])
def test_range_coder(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 50_258, n), rng.integers(0, 2, n), np.full(n, 7), (rng.zipf(1.3, n) % 50_000)):
        block = rc.pack_block([None, 5], [n, 0], ids.astype("<u4"))
        docs, sizes, back = rc.unpack_block(block)
        assert docs == [None, 5] and list(sizes) == [n, 0] and (back == ids).all()
    bad = bytearray(block)
    bad[len(bad) // 2] ^= 1
    with pytest.raises(ValueError):
        rc.unpack_block(bytes(bad))


def test_range_coder_compresses():
    text = np.tile(np.random.default_rng(0).integers(0, 50_000, 500), 400)
    assert len(rc.pack_block([1], [len(text)], text.astype("<u4"))) < len(text)


def test_range_coder_beats_order_0(spark, sf_dir):
    """The higher orders earn their place: a block is smaller than the entropy of
    its ids' own frequencies, which no order-0 model can undercut."""
    texts = [r.text for r in table(spark, sf_dir.replace("sf0.001", "sf0.01"), "documents").select("text").collect()]
    raw = b"".join(tf.Pieces(tf.default_tokenizer()).encode([t or "" for t in texts]))
    ids = np.frombuffer(raw, dtype="<u4")[:rc.BLOCK_IDS]
    share = np.bincount(ids)[np.unique(ids)] / len(ids)
    assert len(rc.pack_block([1], [len(ids)], ids)) * 8 / len(ids) < 0.95 * -(share * np.log2(share)).sum()


# ---- nearest neighbours

def brute_nearest(rows, k=5):
    ok = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and None not in v
          and np.isfinite(np.array(v, dtype=float)).all() and any(v)]
    out = {}
    for i, v in ok:
        if i % 50 == 0:
            near = sorted({(-round(float(v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w))), 9), j) for j, w in ok if j != i and len(w) == len(v)})
            out[i] = [(j, -c) for c, j in near[:k]]
    return out


def test_neighbours_small(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.standard_normal(8).astype(np.float32).tolist()) for k in range(300)]
    same = rows[100][1]
    rows += [(400 + k, same) for k in range(30)] + [(500, None), (501, []), (502, [0.0] * 8), (550, [1.0, None] * 4),
             (600, [float("nan")] * 8), (601, [float("inf")] + [1.0] * 7), (None, same), (650, [1.0, 2.0]), (651, [2.0, 4.0]),
             (700, [1.0, 1.0, 1.0]), (750, [-x for x in same])]
    rows.append(rows[3])
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, cell string")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0, confidence=0.999999).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
        assert r["rank"] == len(got[r.query_id])
    want = {q: v for q, v in brute_nearest(rows).items() if v}
    assert got.keys() == want.keys()
    for q in want:
        assert [c for _, c in got[q]] == pytest.approx([c for _, c in want[q]], abs=1e-7)
    assert [i for i, _ in got[100]] == [400, 401, 402, 403, 404]
    assert [i for i, _ in got[400]] == [100, 401, 402, 403, 404]
    assert got[650] == [(651, 1.0)] and 700 not in got
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_neighbours_recall(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 100)
    df = table(spark, sf_dir.replace("sf0.001", "sf0.01"), "embeddings")
    out = neighbours.nearest(df, F.col("vec_id") % 10 == 0).toPandas()
    pdf = df.toPandas()
    x = np.stack(pdf.embedding).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    hits = total = 0
    for k in np.flatnonzero(pdf.vec_id % 10 == 0):
        s = x @ x[k]
        s[k] = -2
        best = set(pdf.vec_id.to_numpy()[np.lexsort((pdf.vec_id, -s))[:5]])
        hits += len(best & set(out[out.query_id == pdf.vec_id[k]].vec_id))
        total += 5
    assert hits / total >= 0.9


def clustered(n=20_000, groups=400, size=128):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((groups, size))
    return centres[np.arange(n) % groups] + 0.3 * rng.standard_normal((n, size))


def test_neighbours_verify_few_rows_of_clusters():
    x = neighbours.unit(clustered())
    block, points = neighbours.Block(x), neighbours.project(x)
    test = neighbours.chi_square_quantile(neighbours.CONFIDENCE, neighbours.DIMS)
    hits, asked = 0, range(0, len(x), 100)
    for q in asked:
        rows, cosines = block.search(x[q], points[q], np.zeros(0), 6, test)
        got = rows[np.argsort(-cosines)][:6]
        hits += len(set(got) & set(np.argsort(-(x @ x[q]))[:6])) - 1
    assert hits / (5 * len(asked)) >= 0.9
    assert block.verified / (len(asked) * len(x)) < 0.2


def test_neighbours_of_dealt_cells(spark, monkeypatch):
    """Overfull cells and many queries of one cell, in blocks."""
    monkeypatch.setattr(neighbours, "MAX_CELLS", 2)
    monkeypatch.setattr(neighbours, "CELL_ROWS", 50)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 90)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 30)
    x = clustered(1000, 20, 16)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = neighbours.nearest(df, F.col("vec_id") % 5 == 0, confidence=0.999999).collect()
    got = {(r.query_id, r["rank"]): r.vec_id for r in out}
    u = neighbours.unit(x)
    want = {}
    for q in range(0, 1000, 5):
        s = u @ u[q]
        s[q] = -2
        want.update({(q, k + 1): int(i) for k, i in enumerate(np.argsort(-s)[:5])})
    assert got == want


def test_plain_split_agrees_with_the_property_classes():
    import unicodedata

    import regex

    every = [chr(c) for c in range(1 << 16) if re.fullmatch(f"[{tf.PLAIN}]", chr(c))]
    for c in every:
        kind = unicodedata.category(c)
        assert bool(re.fullmatch(r"[^\W\d_]", c)) == (kind[0] == "L"), hex(ord(c))
        assert bool(re.fullmatch(r"\d", c)) == (kind[0] == "N"), hex(ord(c))
        assert bool(re.fullmatch(r"\s", c)) == (c in "\t\n\r \xa0"), hex(ord(c))
    rng = random.Random(6)
    split = regex.compile(tf.PATTERN).findall
    for _ in range(300):
        text = "".join(rng.choice(every + list(" \n'_s1a") * 40) for _ in range(200))
        assert re.findall(tf.PLAIN_PATTERN, text) == split(text)


def test_pieces_agree_with_the_library():
    """Split and put together as arrays: the library's ids on texts of odd spaces,
    contractions and the letters that Unicode versions differ in."""
    rng, pieces = random.Random(9), tf.Pieces(tf.default_tokenizer())
    odd = list(" \n\t'_s1a tdmrevl'l") * 6 + list("\u2003\u3000\x1c\x1f\x85\u200b\u0301\xe9\u6587\U0001f642\u0663\xb2\u2167\u01c5\0\r\x0b\xa0\u2019\u0558\U00020000")
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(40))) for _ in range(2000)]
    texts += [f"a{c} {c}b {c}{c}\n{c}'s" for c in map(chr, [*range(0xD800), *range(0xE000, 0x11000)])]
    texts += ["", "", "a<|endoftext|>b", " ", "<|endoftext|>", "x"]
    want = [pieces.pack(e.ids) for e in pieces.library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):      # the second time from the cache
        assert pieces.encode(texts) == want
    assert pieces.encode([]) == []


def test_pieces_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tf, "CACHE_PIECES", 50)
    pieces = tf.Pieces(tf.default_tokenizer())
    for k in range(60):
        texts = [f"the same words again and again w{k} x{k * 7} {'y' * k}", "of those"]
        assert pieces.encode(texts) == pieces.whole(texts)
        assert len(pieces.fresh) + len(pieces.kept) <= 50
    assert " again".encode() in {**pieces.kept, **pieces.fresh}


def test_pieces_cost_an_eighth_of_the_library_at_most():
    import time

    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("etaoinshrdlué") for _ in range(rng.randrange(2, 9))) for _ in range(5000)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(500)) + "." for _ in range(200)]
    pieces = tf.Pieces(tf.default_tokenizer())
    pieces.encode(texts)

    def cost(f) -> float:
        took = []
        for _ in range(5):
            began = time.process_time()
            f(texts)
            took.append(time.process_time() - began)
        return min(took)

    assert cost(pieces.encode) < cost(pieces.whole) / 8


def test_range_coder_takes_any_ids():
    rng = np.random.default_rng(4)
    many = rng.integers(0, 1 << 32, rc.MOST_IDS + 99, dtype=np.uint64).astype("<u4")
    for ids in (many, np.array([0, (1 << 32) - 1, 5, 5], dtype="<u4")):
        docs, sizes, back = rc.unpack_block(rc.pack_block([1 << 60], [len(ids)], ids))
        assert docs == [1 << 60] and (back == ids).all()
