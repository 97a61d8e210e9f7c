"""Approximate nearest neighbours by stable projections and kd-trees.

Nearness is the largest cosine. Vectors are scaled to length 1, where the
cosine's order is that of the Euclidean distance, and projected to ``DIMS``
numbers by a Gaussian (2-stable) matrix: a pair at distance d is projected to a
squared distance of d^2 times a chi-square variable of ``DIMS`` degrees.

1. Equal vectors are indexed once with their smallest ids, more than any query
   can return, so copies cost nothing and ties stay exact.
2. A kd-tree over the projections of a bounded sample (``SAMPLE`` rows by a hash
   of the id; exact for fewer) cuts space into cells; every row is indexed in its
   cell.
3. Each query searches its own cell first. The k-th best distance found bounds
   the rest: a further cell is searched only if its projected distance passes the
   chi-square test below.
4. Within a cell a kd-tree has the projected points in small leaves. Of the leaves
   whose boxes pass the test, a query verifies rows one by one by rising projected
   distance with true cosines, until the next row fails the test: at ``CONFIDENCE``
   a vector nearer than the k-th found has no projection that far away.

The tree has no more cells than the sample can tell apart (``MAX_CELLS``). A cell
of more than ``BLOCK_ROWS`` rows is dealt into blocks by a hash, each with its own
kd-tree, and the queries of a cell into blocks of ``QUERY_ROWS``; a task holds one
block of each, whatever the size of the table or of one cell. Nothing but the
sample's projections reaches the driver.

Vectors that are null, empty, zero or hold null or non-finite components, and
rows with a null id, take no part; vectors are compared with those of their own
length only; rows repeated with id and vector count once; a query with fewer
candidates returns all of them; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from pressroom.llm.common import materialize, read

DIMS = 16           # even: the chi-square distribution then has a closed form
CONFIDENCE = 0.98
SAMPLE = 20_000
CELL_ROWS = 4096
MAX_CELLS = 1024
BLOCK_ROWS = 8192
QUERY_ROWS = 16384
LEAF = 32
STEP = 16
SEED = 5
QUERY_BATCH = 256


def chi_square_quantile(p: float, dims: int) -> float:
    """x with P(chi-square of ``dims`` (even) degrees <= x) = p."""
    def cdf(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, dims // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return high


def unit(x: np.ndarray) -> np.ndarray:
    # divided by the largest component first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def project(x: np.ndarray, dims: int = DIMS, seed: int = SEED) -> np.ndarray:
    """Projections of unit vectors."""
    return x @ np.random.default_rng(seed).standard_normal((x.shape[1], dims))


class Cells:
    """A kd-tree over sampled projections; its leaves are the index cells."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.axis, self.cut = np.zeros((1 << depth) - 1, dtype=np.int64), np.zeros((1 << depth) - 1)
        groups = [points]
        for node in range((1 << depth) - 1):
            own = groups[node]
            axis = int(np.argmax(own.max(0) - own.min(0))) if len(own) else 0
            self.axis[node] = axis
            self.cut[node] = np.median(own[:, axis]) if len(own) else 0.0
            right = own[:, axis] > self.cut[node] if len(own) else np.zeros(0, dtype=bool)
            groups += [own[~right], own[right]]

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(self.depth):
            right = points[np.arange(len(points)), self.axis[node]] > self.cut[node]
            node = 2 * node + 1 + right
        return node - ((1 << self.depth) - 1)

    def far(self, points: np.ndarray) -> np.ndarray:
        """Squared projected distance of each point to each cell (a lower bound)."""
        gaps = [np.zeros((len(points), points.shape[1]))]
        for node in range((1 << self.depth) - 1):
            axis, side = self.axis[node], points[:, self.axis[node]] - self.cut[node]
            for away in (np.maximum(side, 0), np.maximum(-side, 0)):
                gap = gaps[node].copy()
                gap[:, axis] = np.maximum(gap[:, axis], away)
                gaps.append(gap)
        return np.stack([(g * g).sum(1) for g in gaps[(1 << self.depth) - 1:]], axis=1)


def _leaves(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers of a kd-tree's leaves."""
    todo, out = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        own = points[rows]
        axis = int(np.argmax(own.max(0) - own.min(0)))
        order = rows[np.argsort(own[:, axis], kind="stable")]
        todo += [order[:len(order) // 2], order[len(order) // 2:]]
    return out


class Block:
    """The index of a block of one cell: unit vectors and projections in leaf
    order, with each leaf's box; ``verified`` counts the rows compared."""

    def __init__(self, vectors: np.ndarray):
        vectors = unit(vectors)
        points = project(vectors)
        leaves = _leaves(points, LEAF)
        self.order = np.concatenate(leaves)
        self.vectors, self.points = vectors[self.order], points[self.order]
        self.sizes = np.array([len(x) for x in leaves])
        self.low = np.stack([points[x].min(0) for x in leaves])
        self.high = np.stack([points[x].max(0) for x in leaves])
        self.verified = 0

    def search(self, query: np.ndarray, point: np.ndarray, found: np.ndarray, keep: int, test: float):
        """Row numbers and cosines of verified rows that may be among the best
        ``keep``; ``found`` holds cosines known from elsewhere."""
        def bound(best: np.ndarray) -> float:
            return test * max(2 - 2 * best[keep - 1], 0) + 1e-12 if len(best) >= keep else math.inf

        best, limit = found, bound(found)
        near = np.arange(len(self.order))
        if limit < math.inf:
            gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
            near = np.flatnonzero(np.repeat((gap * gap).sum(axis=1) <= limit, self.sizes))
        far = self.points[near] - point
        far = np.einsum("ij,ij->i", far, far)
        near, far = near[far <= limit], far[far <= limit]
        rising = np.argsort(far, kind="stable")
        near, far = near[rising], far[rising]
        rows, cosines, at, step = [], [], 0, STEP
        while (end := min(at + step, int(np.searchsorted(far, limit, side="right")))) > at:
            cos = self.vectors[near[at:end]] @ query
            rows.append(self.order[near[at:end]])
            cosines.append(cos)
            best = -np.sort(-np.concatenate([best, cos]))[:keep]
            limit, at, step = bound(best), end, min(2 * step, 16 * STEP)
        self.verified += at
        if not rows:
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        rows, cosines = np.concatenate(rows), np.concatenate(cosines)
        # ties at the last place stay in, up to rounding
        ok = cosines >= (best[keep - 1] - 1e-9 if len(best) >= keep else -2)
        return rows[ok], cosines[ok]


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of two original vectors in double precision."""
    with np.errstate(all="ignore"):
        value = float(np.dot(a, b) / (np.sqrt(np.dot(a, a)) * np.sqrt(np.dot(b, b))))
    if not math.isfinite(value):  # squares beyond the range of doubles
        value = float(np.dot(unit(a[None])[0], unit(b[None])[0]))
    return value


def usable(vec: Column) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


_FOUND = "query_id long, vec_id long, score double"


def _dealt(index: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``row_block`` and ``query_block`` numbers within each cell,
    every block of a cell's rows meeting every block of its queries once."""
    def blocks(rows: DataFrame, most: int, name: str) -> DataFrame:
        return rows.groupBy("size", "cell").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(name))

    # a row per cell
    counts = materialize(blocks(index, BLOCK_ROWS, "row_blocks").join(
        blocks(queries, QUERY_ROWS, "query_blocks"), ["size", "cell"]), "cells")

    def dealt(rows: DataFrame, key: Column, own: str, other: str) -> DataFrame:
        return (rows.join(counts, ["size", "cell"])
                .withColumn(f"{own}_block", F.pmod(F.xxhash64(key), F.col(f"{own}_blocks")).cast("int"))
                .withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
                .drop("row_blocks", "query_blocks"))

    return (dealt(index, F.col("ids")[0], "row", "query"), dealt(queries, F.col("query_id"), "query", "row"))


def _search(index: DataFrame, queries: DataFrame, keep: int, test: float) -> DataFrame:
    """Best rows of each query in the cells that it is routed to. ``index(size,
    cell, ids, vec)``, ``queries(size, cell, query_id, vec, known)``."""
    index, queries = _dealt(index, queries)
    by = ["size", "cell", "row_block", "query_block"]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        vectors = np.stack(left["vec"].to_numpy()).astype(np.float64)
        ids = left["ids"].to_numpy()
        block = Block(vectors)
        out: list[tuple[int, int, float]] = []
        for at in range(0, len(right), QUERY_BATCH):
            part = right.iloc[at:at + QUERY_BATCH]
            raw = np.stack(part["vec"].to_numpy()).astype(np.float64)
            scaled = unit(raw)
            points = project(scaled)
            for k, (q, known) in enumerate(zip(part["query_id"].tolist(), part["known"])):
                # the query's own vector may be found with one id that is no candidate
                rows, cosines = block.search(scaled[k], points[k], -np.sort(-np.asarray(known, dtype=float)),
                                             keep + 1, test)
                got = [(c, i, r) for r, c in zip(rows.tolist(), cosines.tolist()) for i in ids[r] if i != q]
                got = sorted(((cosine(raw[k], vectors[r]), i) for _, i, r in got), key=lambda x: (-x[0], x[1]))[:keep]
                out += [(q, i, c) for c, i in got]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return queries.groupBy(*by).cogroup(index.groupBy(*by)).applyInPandas(
        lambda a, b: run(b, a), _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            confidence: float = CONFIDENCE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest cosine for
    each row for which ``is_query`` (over the table's columns) holds."""
    rows = vectors.where(usable(F.col(vec_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"))
    # k + 1 smallest ids of equal vectors: the query's own may be among them
    first = Window.partitionBy("vec").orderBy("id")
    distinct = materialize(
        rows.select("id", "vec").withColumn("rank", F.dense_rank().over(first)).where(F.col("rank") <= k + 1)
        .groupBy("vec").agg(F.array_sort(F.collect_set("id")).alias("ids"))
        .select("vec", "ids", F.size("vec").alias("size")), "vectors")
    sizes = {r["size"]: r["n"] for r in distinct.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    trees = {size: _fit(distinct.where(F.col("size") == size), n) for size, n in sizes.items()}
    test = chi_square_quantile(confidence, DIMS)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell = np.zeros(len(batch), dtype=np.int64)
            for size, at in batch.groupby("size").indices.items():
                x = np.stack(batch["vec"].to_numpy()[at]).astype(np.float64)
                cell[at] = trees[size].of(project(unit(x)))
            yield batch.assign(cell=cell)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, at in batch.groupby("size").indices.items():
                part = batch.iloc[at]
                for begin in range(0, len(part), QUERY_BATCH):
                    some = part.iloc[begin:begin + QUERY_BATCH]
                    far = trees[size].far(project(unit(np.stack(some["vec"].to_numpy()).astype(np.float64))))
                    kth = np.array([2 - 2 * min(x) if len(x) >= k else np.inf for x in some["known"]])
                    open_ = far <= test * np.maximum(kth, 0)[:, None] + 1e-12
                    open_[np.arange(len(some)), some["cell"].to_numpy()] = False
                    which, cells = np.nonzero(open_)
                    yield some.iloc[which].assign(cell=cells)

    index = materialize(distinct.mapInPandas(place, f"{_ddl(distinct)}, cell long"), "index")
    asked = rows.where("is_query").select(F.col("id").alias("query_id"), "vec").distinct().withColumn("size", F.size("vec"))
    own = materialize(asked.mapInPandas(place, f"{_ddl(asked)}, cell long"), "queries")
    none = F.array().cast("array<double>")
    near = materialize(_best(_search(index, own.withColumn("known", none), k, test), k), "near")
    known = near.groupBy("query_id").agg(F.collect_list("score").alias("known"))
    ready = own.join(known, "query_id", "left").withColumn("known", F.coalesce("known", none))
    routed = ready.mapInPandas(route, _ddl(ready))
    more = _search(index, routed, k, test)
    return _best(near.select("query_id", "vec_id", "score").unionByName(more), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _fit(rows: DataFrame, n: int) -> Cells:
    """Cells of about CELL_ROWS rows, from a bounded sample."""
    share = min(1.0, SAMPLE / n)
    picked = rows if share == 1.0 else rows.where(
        F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(1 << 32)) < int(share * (1 << 32)))

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"p": list(project(unit(np.stack(batch["vec"].to_numpy()).astype(np.float64))))})

    points = picked.select("vec").mapInPandas(shrink, "p array<double>").toPandas()["p"]
    depth = max(0, min(math.ceil(math.log2(max(n / CELL_ROWS, 1))), int(math.log2(MAX_CELLS))))
    return Cells(np.stack(points.to_numpy()) if len(points) else np.zeros((0, DIMS)), depth)


def op10_neighbours(spark, sf_dir):
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
