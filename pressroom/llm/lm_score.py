"""Language-model scoring by cross-entropy difference.

Tokens are the words of a whole text (``common.words``) and an end token, which
also stands before the first word. Two bigram models share one vocabulary, all
words of the corpus, so no token is unknown, and one estimator: the target model
counts the target documents, the background model every document. With prior
weight m, counts c, and q(w) the share of w among all tokens of the corpus,

    p(w)     = (c(w) + m q(w)) / (c() + m)
    p(w | v) = (c(v w) + m p(w)) / (c(v) + m)

Background counts enter as the share that a sample of the target's size would
have: the models are matched, as the same prior meets the same amount of text in
both, and still rest on every document. A document's score is the mean over its
tokens of target loss minus background loss, in bits: the lower, the more it is
like the target.

1. Each task takes documents in chunks of some ``CHUNK_TOKENS`` tokens and writes a
   chunk's words once and its tokens as places among these. No text is shuffled: ids
   alone are joined with the targets, and a chunk gets the places of its targets.
2. A chunk's bigrams and words are its entries, with counts: a frequent one is one
   entry a chunk, however often it occurs. They are dealt by ranges of their hashes
   into as many parts as the corpus asks for; a part adds up the counts of all chunks
   and returns to each the sums of entries that other chunks have as well. The
   counts of all others are the chunk's own.
3. Each chunk takes the losses of its tokens from these counts and adds them up for
   its documents. What is counted and returned grows with the corpus; only two
   totals go to the driver.

Words and bigrams are compared by 64-bit hashes. A null text counts as empty (the end
token only); null ids are background and are scored; repeated documents are counted and
scored one by one, and a target id at several documents makes all of them targets;
without target documents both models are q and scores are 0; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pressroom.llm.common import materialize, partitions, read, words

#: A chunk is closed when it has this many tokens; a longer document is a chunk of its own.
CHUNK_TOKENS = 1 << 20
#: Tokens of the corpus for each part that entries are dealt into.
PART_TOKENS = 1 << 22
PRIOR = 100.0
END = 0
PAIR = np.uint64(0x9E3779B97F4A7C15)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as byte planes, without the planes that are zero in all."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + planes[:, :width].T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    width, n = data[0], (len(data) - 1) // data[0]
    planes = np.zeros((n, 8), np.uint8)
    planes[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(width, n).T
    return planes.reshape(-1).view("<u8")


def _spread(x: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit numbers, so that equal ranges hold equal shares."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Chunk:
    """Tokens of some documents: ``words`` (hashes), ``token`` (places among
    these), ``before`` (the token before each), and the sorted ``entries`` with
    their ``counts`` of background and target; ``pair`` and ``single`` are the
    entries of each token's bigram and of each word."""

    def __init__(self, words: np.ndarray, token: np.ndarray, n: np.ndarray, target: np.ndarray):
        self.words, self.token = words, token
        self.before = np.concatenate([[np.searchsorted(words, END)], token[:-1]])
        one = _spread(words)
        # the end token's hash is 0, so a bigram is mixed once more, lest it be its other word's
        two = _spread((one[self.before] << np.uint64(1) | one[self.before] >> np.uint64(63)) ^ one[token] ^ PAIR)
        self.entries, code = np.unique(np.concatenate([two, one]), return_inverse=True)
        self.pair, self.single = code[:len(token)], code[len(token):]
        self.counts = []
        for chosen in (slice(None), np.repeat(target, n)):
            count = np.bincount(self.pair[chosen], minlength=len(self.entries))
            count[self.single] += np.bincount(token[chosen], minlength=len(words))
            self.counts.append(count)

    @classmethod
    def of_row(cls, row: dict) -> "Chunk":
        n = np.array(row["n_tokens"], np.int64)
        target = np.zeros(len(n), bool)
        target[np.array(row["places"] or [], np.int64)] = True
        return cls(np.cumsum(unpacked(row["words"]), dtype=np.uint64), unpacked(row["tokens"]).astype(np.int64), n, target)

    def parts(self, n_parts: int) -> np.ndarray:
        """The part of each entry, rising as the entries do."""
        return ((self.entries >> np.uint64(32)) * np.uint64(n_parts) >> np.uint64(32)).astype(np.int64)


def _one(values, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def chunked(docs: DataFrame) -> DataFrame:
    """One row per chunk of ``docs(id, words array<long>)``: its documents' ``ids``
    and ``n_tokens``, their ``tokens``, and the distinct ``words``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no, held, size = TaskContext.get().partitionId() << 32, [], 0

        def close() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            ids, texts = (pa.concat_arrays(rows[c].chunks) for c in range(2))
            n = texts.value_lengths().to_numpy().astype(np.int64) + 1
            token, inside = np.full(n.sum(), END, np.uint64), np.ones(n.sum(), bool)
            inside[np.cumsum(n) - 1] = False
            token[inside] = texts.flatten().to_numpy().view(np.uint64)
            words, token = np.unique(token, return_inverse=True)
            return pa.RecordBatch.from_pydict({
                "chunk": pa.array([no], pa.int64()), "ids": _one(ids, ids.type), "n_tokens": _one(n, pa.int64()),
                "tokens": pa.array([packed(token)], pa.binary()),
                "words": pa.array([packed(np.diff(words, prepend=np.uint64(0)))], pa.binary())})

        for batch in batches:
            until = np.cumsum(batch.column(1).value_lengths().to_numpy(zero_copy_only=False) + 1, dtype=np.int64)
            begin = 0
            while begin < len(until):
                done = until[begin - 1] if begin else 0
                end = min(int(np.searchsorted(until, done + CHUNK_TOKENS - size)) + 1, len(until))
                held.append(batch.slice(begin, end - begin))
                size, begin = size + until[end - 1] - done, end
                if size >= CHUNK_TOKENS:
                    yield close()
                    no, held, size = no + 1, [], 0
        if held:
            yield close()

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "words").mapInArrow(
        run, f"chunk long, ids array<{kind}>, n_tokens array<long>, tokens binary, words binary")


def target_places(chunks: DataFrame, targets: DataFrame) -> DataFrame:
    """``chunk, places``: the places of target documents (``targets(id)``) within
    their chunk, and ``n_target``, their tokens."""
    ids = chunks.select("chunk", F.posexplode(F.arrays_zip("ids", "n_tokens")).alias("place", "x")).select(
        "chunk", "place", F.col("x.ids").alias("id"), F.col("x.n_tokens").alias("n"))
    return (ids.where("id IS NOT NULL").join(targets, "id", "left_semi").groupBy("chunk")
            .agg(F.collect_list("place").alias("places"), F.sum("n").alias("n_target")))


def shared_counts(chunks: DataFrame, n_parts: int) -> DataFrame:
    """``chunk, part, places, background, target``: a chunk's entries of a part
    that stand in other chunks too, and their counts over all chunks."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk.of_row(row)
                parts, first = np.unique(chunk.parts(n_parts), return_index=True)
                to = [*first.tolist(), len(chunk.entries)]
                cut = lambda x, f=lambda v: v: [packed(f(x[i:j])) for i, j in zip(to, to[1:])]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(parts, pa.int32()), "chunk": pa.array([row["chunk"]] * len(parts), pa.int64()),
                    "entries": cut(chunk.entries, lambda v: np.diff(v, prepend=np.uint64(0))),
                    "background": cut(chunk.counts[0]), "target": cut(chunk.counts[1])})

    def add(rows: pa.Table) -> pa.Table:
        lists = [np.cumsum(unpacked(x), dtype=np.uint64) for x in rows["entries"].to_pylist()]
        ends = np.cumsum([len(x) for x in lists])
        _, code, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        sums = {c: np.bincount(code, np.concatenate([unpacked(x) for x in rows[c].to_pylist()]))
                for c in ("background", "target")}
        out = {c: [] for c in ("places", "background", "target")}
        for i, j in zip([0, *ends[:-1]], ends):
            place = np.flatnonzero(times[code[i:j]] > 1)
            out["places"].append(packed(np.diff(place, prepend=0)))
            for c, total in sums.items():
                out[c].append(packed(total[code[i:j][place]]))
        return pa.table({"chunk": rows["chunk"], "part": rows["part"], **{c: pa.array(x, pa.binary()) for c, x in out.items()}})

    return (chunks.select("chunk", "words", "tokens", "n_tokens", "places")
            .mapInArrow(deal, "part int, chunk long, entries binary, background binary, target binary")
            .groupBy("part").applyInArrow(add, "chunk long, part int, places binary, background binary, target binary"))


def score_documents(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    prior: float = PRIOR) -> DataFrame:
    """``id_col, n_tokens, target_loss, background_loss, score`` per document;
    ``targets(id_col)`` names the target documents."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chunks = materialize(chunked(rows.select("id", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("words"))),
                         "chunks")
    chosen = targets.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct()
    places = materialize(target_places(chunks, chosen), "target-places")
    n_all = chunks.agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda x, n: x + n))).first()[0] or 0
    n_target = places.agg(F.sum("n_target")).first()[0] or 0
    n_parts = max(partitions(docs.sparkSession), n_all // PART_TOKENS + 1)
    share, size = [n_target / max(n_all, 1), 1.0], [n_all, n_target]
    marked = chunks.join(places.select("chunk", "places"), "chunk", "left")

    def score(own: pa.Table, sums: pa.Table) -> pa.Table:
        own = own.combine_chunks()
        row = own.drop_columns(["ids"]).to_pylist()[0]
        chunk, n = Chunk.of_row(row), np.array(row["n_tokens"], np.int64)
        begin = np.searchsorted(chunk.parts(n_parts), np.arange(n_parts))
        for part in sums.to_pylist():
            place = begin[part["part"]] + np.cumsum(unpacked(part["places"])).astype(np.int64)
            for count, c in zip(chunk.counts, ("background", "target")):
                count[place] = unpacked(part[c])
        loss, base = [], chunk.counts[0][chunk.single] / n_all
        for count, s, tokens in zip(chunk.counts, share, size):
            # every token also stands before one: a word's count is its count as a context too
            single = s * count[chunk.single]
            one = (single + prior * base) / (s * tokens + prior)
            p = (s * count[chunk.pair] + prior * one[chunk.token]) / (single[chunk.before] + prior)
            loss.append(-np.add.reduceat(np.log2(p), np.cumsum(n) - n) / n)
        return pa.table({"id": pa.concat_arrays(own["ids"].chunks).flatten(), "n_tokens": n, "target_loss": loss[1],
                         "background_loss": loss[0], "score": loss[1] - loss[0]})

    return (marked.groupBy("chunk").cogroup(shared_counts(marked, n_parts).groupBy("chunk"))
            .applyInArrow(score, f"id {kind}, n_tokens long, target_loss double, background_loss double, score double")
            .withColumnRenamed("id", id_col))


def op4_lm_score(spark, sf_dir):
    labels = read(spark, sf_dir, "labels")
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id")
    return score_documents(read(spark, sf_dir, "documents"), good)
