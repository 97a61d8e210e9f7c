"""N-gram Jaccard self-join with Bayesian candidate pruning.

A document is the set of its five-word shingles (all its words, if fewer); two
are linked at a Jaccard similarity of ``THRESHOLD`` or more.

1. Documents with equal shingle sets form one class, represented by its smallest
   id; only representatives are compared, so copies cost nothing.
2. ``HASHES`` MinHash values in bands of ``ROWS`` give candidate buckets; a pair
   at the threshold misses all of them with probability 5e-8.
3. Within a bucket, the pairs compare their MinHash values incrementally,
   ``STEP`` at a time, and are dropped as soon as the posterior probability of
   reaching the threshold (uniform prior) falls below ``TOLERANCE``. A pair is
   handled in the first band that it shares only, by 32-bit digests of the bucket
   keys (an earlier band is taken for shared, and the pair missed, with a
   probability of 31 / 2^32 at most). What is emitted are spanning
   edges of the surviving pairs, fewer than the members; their components hold
   all the pairs that can be links.
4. In each component, all pairs are pruned the same way and the rest is verified
   exactly on the shingle sets. Emitted are each class's number of links and
   spanning edges of the links, whose components are the near-duplicate groups.

A bucket or component of more than ``BLOCK`` members is cut into blocks, and each
pair of blocks is a unit of its own that any task can take: no group is ever
gathered whole, and no table holds a row per pair. Counting the links of a large
group of different texts stays quadratic in that group alone.

Null and word-less texts have no shingles and no links; each is a group of its
own. Rows equal in id and text count as one document; a null id has no links; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pressroom.llm.common import LOWER, UPPER, free_name, materialize, partitions, read
from pressroom.llm.graph import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-6
BLOCK = 1024
SEED = 23
U = np.uint64
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (xor-shift and multiply)."""
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(29))) * U(0xA0761D6478BD642F)
    return h ^ (h >> U(32))


def shingle_sets(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    raw = "\0".join(texts).encode("utf-8", "surrogatepass").translate(ASCII_LOWER) + b"\0"
    data = np.frombuffer(raw, dtype=np.uint8)
    inside = (data >= 128) | ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 122))
    edge = np.diff(np.concatenate([[False], inside, [False]]).view(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # texts may hold NUL characters of their own, so text ends are counted from lengths
    ends = np.cumsum([len(t.encode("utf-8", "surrogatepass")) + 1 for t in texts])
    if not len(begin):
        return [np.zeros(0, dtype=U) for _ in texts]
    # polynomial hash of each word: bytes spread by a table, times a power of their place
    spread = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
    place = np.arange(len(data)) - np.repeat(np.concatenate([[0], begin]), np.diff(np.concatenate([[0], begin, [len(data)]])))
    power = np.cumprod(np.full(int((end - begin).max()) + 1, 0x5851F42D4C957F2D, dtype=U))
    value = np.where(inside, spread[data] * power[np.minimum(place, len(power) - 1)], U(0))
    word = mix(np.add.reduceat(value, begin) + (end - begin).astype(U))
    odd = mix(np.arange(1, size + 1, dtype=U)) | U(1)
    cut = np.searchsorted(begin, ends)
    out, at = [], 0
    for stop in cut:
        own = word[at:stop]
        at = stop
        if not len(own):
            out.append(np.zeros(0, dtype=U))
            continue
        k = min(size, len(own))
        n = len(own) - k + 1
        h = np.zeros(n, dtype=U)
        for i in range(k):
            h += own[i:i + n] * odd[i]
        out.append(np.unique(mix(h + U(k))))
    return out


def set_key(shingles: np.ndarray) -> bytes:
    """A 128-bit digest of a shingle set."""
    import hashlib

    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """HASHES MinHash values (32 bits each)."""
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * U(2) + U(1)
    b = rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * U(2)
    best = np.full(HASHES, (1 << 64) - 1, dtype=U)
    for at in range(0, len(shingles), 2048):
        best = np.minimum(best, (np.multiply.outer(shingles[at:at + 2048], a) + b).min(axis=0))
    return (best >> U(32)).astype("<u4")


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """64-bit bucket key of each band; rows of HASHES MinHash values."""
    hashes = hashes.reshape(-1, BANDS, ROWS).astype(U)
    key = np.zeros(hashes.shape[:2], dtype=U)
    for r in range(ROWS):
        key = mix(key + hashes[:, :, r] + U(r + 1))
    return mix(key + np.arange(1, BANDS + 1, dtype=U))


def fewest_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, step: int = STEP) -> list[int]:
    """After each ``step`` hashes, the fewest equal low bytes at which the
    similarity reaches the threshold with a posterior of ``tolerance`` at least."""
    s = (np.arange(20_000) + 0.5) / 20_000
    p = s + (1 - s) / 256
    out = []
    for n in range(step, HASHES + 1, step):
        m = np.arange(n + 1)[:, None]
        like = m * np.log(p) + (n - m) * np.log1p(-p)
        like = np.exp(like - like.max(axis=1, keepdims=True))
        posterior = like[:, s >= threshold].sum(axis=1) / like.sum(axis=1)
        out.append(int(np.argmax(posterior >= tolerance)))
    return out


def survives(low: np.ndarray, i: np.ndarray, j: np.ndarray, fewest: list[int]) -> np.ndarray:
    """Positions of the pairs (i, j) that incremental comparison doesn't drop."""
    alive, equal = np.arange(len(i)), np.zeros(len(i), dtype=np.int64)
    for k, least in enumerate(fewest):
        at = slice(k * STEP, (k + 1) * STEP)
        equal = equal + (low[i[alive], at] == low[j[alive], at]).sum(axis=1)
        keep = equal >= least
        alive, equal = alive[keep], equal[keep]
        if not len(alive):
            break
    return alive


class Forest:
    """Union-find over members; its edges span what was joined."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, pairs: np.ndarray) -> None:
        for x, y in pairs.tolist():
            x, y = self.root(x), self.root(y)
            if x != y:
                self.up[max(x, y)] = min(x, y)

    def edges(self) -> list[tuple[int, int]]:
        return [(x, self.root(x)) for x in list(self.up) if self.root(x) != x]


def _low_bytes(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(len(column), HASHES)


def _whole_groups(batches: Iterator[pd.DataFrame], by: list[str], rows: int) -> Iterator[pd.DataFrame]:
    """Frames of about ``rows`` rows that end where a group of sorted input ends."""
    held: list[pd.DataFrame] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n < rows:
            continue
        frame = pd.concat(held, ignore_index=True)
        last = frame[by].iloc[-1]
        cut = int((frame[by] != last).any(axis=1).to_numpy().nonzero()[0].max(initial=-1)) + 1
        if cut:
            yield frame.iloc[:cut]
        held, n = [frame.iloc[cut:]], len(frame) - cut
        rows = max(rows, 2 * n)
    if n:
        yield pd.concat(held, ignore_index=True)


def _group_starts(frame: pd.DataFrame, by: list[str]) -> np.ndarray:
    new = np.zeros(len(frame), dtype=bool)
    new[0] = True
    for c in by:
        x = frame[c].to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_key, set_key, n, hashes``: one row per document that has words
    and an id (rows equal in id and text once are not merged here)."""
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                sets = shingle_sets(part["text"].tolist())
                full = [k for k, s in enumerate(sets) if len(s)]
                yield pd.DataFrame({
                    "id": part["id"].to_numpy()[full], "text_key": part["text_key"].to_numpy()[full],
                    "set_key": [set_key(sets[k]) for k in full], "n": [len(sets[k]) for k in full],
                    "hashes": [min_hashes(sets[k]).tobytes() for k in full]})

    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.md5(text_col).alias("text_key"))
    return rows.mapInPandas(sign, "id long, text_key string, set_key binary, n int, hashes binary")


def _blocks(rows: DataFrame, group: str, size: str, member: str, block: int) -> DataFrame:
    """Each row once for every pair of blocks (``i`` <= ``j``) that its own block
    ``part`` belongs to; a group within one block has the pair (0, 0)."""
    n = F.ceil(F.col(size) / F.lit(block)).cast("int")
    own = rows.withColumn("part", F.pmod(F.xxhash64(member, F.lit(SEED)), n).cast("int"))
    return (own.withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
            .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")).drop("other"))


def candidate_edges(classes: DataFrame) -> DataFrame:
    """Spanning edges ``a, b`` of the pairs that survive pruning in a bucket.
    ``classes(cls, hashes)``."""
    def band(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                key = band_keys(np.frombuffer(b"".join(batch["hashes"]), dtype="<u4"))
                yield pd.DataFrame({"bucket": key.ravel().view(np.int64),
                                    "band": np.tile(np.arange(BANDS, dtype=np.int32), len(batch)),
                                    "cls": np.repeat(batch["cls"].to_numpy(), BANDS)})

    buckets = classes.select("cls", "hashes").mapInPandas(band, "bucket long, band int, cls long")
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    fewest = fewest_matches()

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by = ["bucket", "i", "j"]
        for frame in _whole_groups(batches, by, 8192):
            starts = _group_starts(frame, by)
            ends = np.repeat(np.append(starts[1:], len(frame)), np.diff(np.append(starts, len(frame))))
            low, cls = _low_bytes(frame["low"]), frame["cls"].to_numpy()
            digest = np.frombuffer(b"".join(frame["digests"]), dtype="<u4").reshape(-1, BANDS)
            band_no = frame["band"].to_numpy()
            part, two = frame["part"].to_numpy(), (frame["i"] != frame["j"]).to_numpy()
            forest, left, d = Forest(), np.arange(len(frame)), 0
            while True:
                d += 1
                left = left[left + d < ends[left]]
                if not len(left):
                    break
                i = left[~two[left] | (part[left] != part[left + d])]
                same = digest[i] == digest[i + d]
                i = i[same.argmax(axis=1) == band_no[i]]
                if len(i):
                    i = i[survives(low, i, i + d, fewest)]
                    forest.join(np.stack([cls[i], cls[i + d]], axis=1))
            if edges := forest.edges():
                yield pd.DataFrame(edges, columns=["a", "b"])

    # the low byte of each hash: equal bytes of unequal hashes are in the posterior
    low = classes.select("cls", _low("hashes").alias("low"), _digests("hashes").alias("digests"))
    rows = _blocks(buckets.join(sizes, "bucket"), "bucket", "size", "cls", BLOCK).join(low, "cls")
    return (rows.select("bucket", "i", "j", "part", "band", "cls", "low", "digests")
            .repartition(partitions(classes.sparkSession), "bucket", "i", "j")
            .sortWithinPartitions("bucket", "i", "j").mapInPandas(prune, "a long, b long"))


def _low(column: str):
    """Every fourth byte of a binary column, as binary."""
    @F.pandas_udf("binary")
    def low(hashes: pd.Series) -> pd.Series:
        return hashes.map(lambda h: h[::4])

    return low(F.col(column))


def _digests(column: str):
    """The upper half of each band's bucket key, as binary."""
    @F.pandas_udf("binary")
    def digests(hashes: pd.Series) -> pd.Series:
        return hashes.map(lambda h: (band_keys(np.frombuffer(h, dtype="<u4")) >> U(32)).astype("<u4").tobytes())

    return digests(F.col(column))


def verified_links(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``a, b, links``: per block pair, each member's links (``a = b``) and the
    spanning edges of the links. ``sets(group, size, cls, low, shingles)``."""
    fewest = fewest_matches(threshold)

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by = ["group", "i", "j"]
        for frame in _whole_groups(batches, by, 512):
            starts = _group_starts(frame, by)
            for at, end in zip(starts, np.append(starts[1:], len(frame))):
                part = frame.iloc[at:end].drop_duplicates("cls")
                if len(part) > 1:
                    yield _verify_block(part, fewest, threshold)

    rows = _blocks(sets, "group", "size", "cls", BLOCK)
    return (rows.select("group", "i", "j", "part", "cls", "low", "shingles")
            .repartition(partitions(sets.sparkSession), "group", "i", "j")
            .sortWithinPartitions("group", "i", "j").mapInPandas(verify, "a long, b long, links long"))


def _verify_block(part: pd.DataFrame, fewest: list[int], threshold: float) -> pd.DataFrame:
    """Links among one block, or between two (``part`` tells the sides)."""
    cls, low, side = part["cls"].to_numpy(), _low_bytes(part["low"]), part["part"].to_numpy()
    across = part["i"].iloc[0] != part["j"].iloc[0]
    sets = [np.frombuffer(s, dtype=U) for s in part["shingles"]]
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark, links, forest = np.zeros(ids.max() + 1, dtype=bool), np.zeros(len(cls), dtype=np.int64), Forest()
    for x in range(len(cls) - 1):
        y = np.arange(x + 1, len(cls))
        if across:
            y = y[side[y] != side[x]]
        y = y[np.minimum(sizes[y], sizes[x]) >= threshold * np.maximum(sizes[y], sizes[x]) - 1e-9]
        y = y[survives(low, np.full(len(y), x), y, fewest)]
        if not len(y):
            continue
        own = ids[ends[x] - sizes[x]:ends[x]]
        mark[own] = True
        at = np.concatenate([np.arange(ends[k] - sizes[k], ends[k]) for k in y])
        both = np.add.reduceat(mark[ids[at]].astype(np.int64), np.concatenate([[0], np.cumsum(sizes[y])[:-1]]))
        mark[own] = False
        y = y[both >= threshold * (sizes[x] + sizes[y] - both) - 1e-9]
        links[x] += len(y)
        links[y] += 1
        forest.join(np.stack([np.full(len(y), cls[x]), cls[y]], axis=1))
    some = np.flatnonzero(links)
    edges = np.array(forest.edges(), dtype=np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": np.concatenate([cls[some], edges[:, 0]]), "b": np.concatenate([cls[some], edges[:, 1]]),
                         "links": np.concatenate([links[some], np.zeros(len(edges), dtype=np.int64)])})


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """``id_col, text_key, copy_id, n_links, class_id, shingled`` per row with an id:
    ``copy_id`` is the smallest id with the same shingles, ``n_links`` the number
    of other classes of equal shingle sets that it links to, ``class_id`` the
    smallest id of the group that links connect, ``text_key`` the text's md5,
    ``shingled`` whether the text has words. Candidates are found for similarities
    from ``THRESHOLD`` up, so a lower ``threshold`` is an error."""
    if threshold < THRESHOLD:
        raise ValueError(f"candidates reach down to a similarity of {THRESHOLD}")
    signed = materialize(signatures(docs, id_col, text_col), "signatures")
    classes = materialize(signed.groupBy("set_key").agg(
        F.min("id").alias("cls"), F.min("hashes").alias("hashes")), "classes")
    # ids can repeat with another text: classes are numbered by id only where that is unique
    clash = classes.groupBy("cls").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("cls")
    classes = classes.join(clash.withColumn("clash", F.lit(True)), "cls", "left").select(
        "set_key", "hashes", F.col("cls").alias("copy_id"),
        F.when(F.col("clash"), -2 - F.pmod(F.xxhash64("set_key"), F.lit(1 << 62))).otherwise(F.col("cls")).alias("cls"))
    groups = components(candidate_edges(classes))
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    members = materialize(groups.join(sizes, "root").select(F.col("node").alias("cls"), F.col("root").alias("group"), "size")
                          .join(classes, "cls").select("cls", "group", "size", "set_key", "copy_id",
                                                       _low("hashes").alias("low")), "members")

    def shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                sets = shingle_sets(part["text"].tolist())
                same = [k for k, (s, want) in enumerate(zip(sets, part["set_key"])) if set_key(s) == bytes(want)]
                got = part.iloc[same]
                yield pd.DataFrame({"group": got["group"], "size": got["size"], "cls": got["cls"], "low": got["low"],
                                    "shingles": [sets[k].tobytes() for k in same]})

    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("copy_id"),
                                                           F.col(text_col).alias("text"))
    sets = texts.join(members, "copy_id").select("group", "size", "cls", "set_key", "low", "text").mapInPandas(
        shingles, "group long, size long, cls long, low binary, shingles binary")
    found = materialize(verified_links(sets, threshold), "links")
    links = found.where("links > 0").groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("n_links"))
    linked = components(found.where("links = 0")).select(F.col("node").alias("cls"), F.col("root"))
    keyed = classes.join(links, "cls", "left").join(linked, "cls", "left").withColumn(
        "root", F.coalesce("root", "cls"))
    least = keyed.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    named = keyed.join(least, "root").select("set_key", "copy_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                                             "class_id")
    everyone = docs.select(F.col(id_col).cast("long").alias("id"), F.md5(F.coalesce(text_col, F.lit(""))).alias("text_key")) \
        .where("id IS NOT NULL")
    by_text = signed.select("id", "text_key", "set_key").join(named, "set_key").drop("set_key").distinct()
    return everyone.join(by_text, ["id", "text_key"], "left").select(
        F.col("id").alias(id_col), "text_key", F.coalesce("copy_id", "id").alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("class_id", "id").alias("class_id"),
        F.col("copy_id").isNotNull().alias("shingled"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` but for near duplicates: of each group the row of the
    smallest id stays (rows equal in id and text count as one). Rows without words
    or without an id stay."""
    found = jaccard_groups(docs, id_col, text_col, **options)
    name = free_name(docs, "text_key")
    best = found.where("shingled").groupBy("class_id").agg(F.min(F.struct(id_col, "text_key")).alias("row"))
    keys = best.select(f"row.{id_col}", F.col("row.text_key").alias(name)).unionByName(
        found.where("NOT shingled").select(id_col, F.col("text_key").alias(name)).distinct())
    key = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    named = docs.where(F.col(id_col).isNotNull()).withColumn(name, key).join(keys, [id_col, name], "left_semi")
    return named.dropDuplicates([id_col, name]).select(docs.columns).unionByName(docs.where(F.col(id_col).isNull()))


def op8_jaccard_join(spark, sf_dir):
    out = jaccard_groups(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "n_links", "copy_id")
