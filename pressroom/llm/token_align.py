r"""Alignment of two tokenizers' ids over the same texts.

Side A is a byte-level BPE (``tokenizers`` JSON file), side B a ``sentencepiece``
model. Both encode a space and the text (B adds that space itself), so the tokens
of both cover the same bytes.

Method: every text is tokenized whole by both sides. A place where a token of
either side ends, checked by the byte offsets of both, and where both next tokens
are marked by a space, is an anchor; anchors cut the text into windows of token
ids. A window's alignment depends on its ids alone, so it is computed once per
``(A ids, B ids)`` and kept in a memo of the Python worker (bounded by the number
of ids that it holds and emptied when full: it saves time and decides nothing).
Within a window two tokens are linked if their byte ranges overlap, and a group
ends where tokens of both sides end.

``aligned`` returns one row per document, dealt into chunks of whole documents
(``CHUNK_BYTES``; a longer document is a chunk of its own). A chunk lists its id
pairs once, with how many links hold each, and its documents count them by their
place in that list. So corpus-wide counts are one aggregate over the chunks'
lists, and go back to the documents by a join of the lists, which are far shorter
than the documents' links; a pair that stands in every chunk is met once a chunk.

Special tokens' strings inside texts are plain text. A text that is null or
empty, or whose joined token bytes differ from space and text on either side (the
text holds B's space mark, say), has no tokens: counts of zero and no groups. A
null id stays null, repeated rows are rows of their own, extra columns are
ignored, an empty table gives no rows.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from pressroom.llm.common import materialize, read
from pressroom.llm.token_files import PATTERN, default_tokenizer

CHUNK_BYTES = 1 << 20
#: Token ids that the memo of a worker holds at most between chunks.
MEMO_IDS = 2_000_000
SPACE_MARK = "▁"
#: Added to B's ids in a window's key.
SIDE_B = np.uint32(1 << 31)


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_chars() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable
    ones stand for themselves, the others are numbered from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class ByteSide:
    """Side A: ids and the bytes of each id."""

    def __init__(self, path: str):
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars, vocab, added = byte_chars(), spec["model"]["vocab"], {t["id"]: t["content"] for t in spec["added_tokens"]}
        bare = {i: bytes(chars[c] for c in t) for t, i in vocab.items() if i not in added}
        self.bytes = {**bare, **{i: t.encode() for i, t in added.items()}}
        self.path, self.library, self.fast = path, None, None
        pre = spec["pre_tokenizer"] or {}
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        numbers = [vocab[m] for m in merges]
        # ids that rise with the merges are the merges' ranks
        if (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                and not spec["normalizer"] and numbers == sorted(numbers)):
            import tiktoken

            self.fast = tiktoken.Encoding("side-a", pat_str=PATTERN, special_tokens={},
                                          mergeable_ranks={b: i for i, b in bare.items()})

    def one(self, text: str) -> list[int] | np.ndarray:
        if not text:
            return ()
        if self.fast:
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except Exception:  # its regular expression gives up on very long runs; the other library doesn't
                pass
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
            self.library.encode_special_tokens = True
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(self.one(t), np.uint32) for t in texts]


class PieceSide:
    """Side B: ids and the bytes of each id."""

    def __init__(self, path: str):
        import re

        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        byte = re.compile("<0x([0-9A-F]{2})>").fullmatch
        self.bytes = {i: bytes([int(m[1], 16)]) if (m := byte(p)) else p.replace(SPACE_MARK, " ").encode()
                      for i, p in enumerate(pieces)}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.uint32) for ids in self.library.encode(texts, num_threads=1)]


class Spelling:
    """Bytes of ids: their number, whether the first is a space, and all of them."""

    def __init__(self, side: ByteSide | PieceSide):
        said = [side.bytes.get(i, b"") for i in range(max(side.bytes) + 1)]
        self.size = np.array([len(b) for b in said], np.int64)
        self.spaced = np.array([b[:1] == b" " for b in said])
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(said), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        return self.flat[np.repeat(self.begin[ids] - np.cumsum(size) + size, size) + np.arange(size.sum())]


class Aligner:
    """Both sides, and the memo of window alignments."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteSide(path_a), PieceSide(path_b)
        self.spell_a, self.spell_b = Spelling(self.a), Spelling(self.b)
        # ids as written, by what follows them
        number = lambda spell, marks: np.array([[f"{i}{m}" for i in range(len(spell.size))] for m in marks], object)
        self.said_a, self.said_b = number(self.spell_a, (",", "|")), number(self.spell_b, (",", ";", ""))
        self.empty()

    def empty(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.held = 0
        self.text: list[str] = []                                # groups of a window
        self.groups, self.links = array("q"), array("q")          # their numbers
        self.pair_of, self.begin = array("q"), array("q")         # its links' pairs, and where they begin
        self.pair_no: dict[int, int] = {}
        self.pairs = array("q")

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides for each text; none if either doesn't cover space and text."""
        texts = [t or "" for t in texts]
        b, texts = self.b.encode(texts), [" " + t if t else "" for t in texts]
        a, raw = self.a.encode(texts), [t.encode() for t in texts]
        size = np.array([len(r) for r in raw], np.int64)
        for ids, spell in ((a, self.spell_a), (b, self.spell_b)):
            # as many bytes, then the same bytes
            fit = [i for i, x in enumerate(ids) if spell.size[x].sum() == size[i]]
            same = spell.joined(np.concatenate([ids[i] for i in fit])) == np.frombuffer(
                b"".join([raw[i] for i in fit]), np.uint8) if fit else np.ones(0, bool)
            wrong = np.diff(np.append(0, np.cumsum(~same))[np.append(0, np.cumsum(size[fit]))])
            for i in set(range(len(texts))).difference(i for i, n in zip(fit, wrong.tolist()) if not n):
                a[i] = b[i] = np.zeros(0, np.uint32)
                size[i], raw[i] = 0, b""
        return a, b

    def learn(self, keys: list[bytes]) -> None:
        """Align windows that the memo hasn't got and put them there."""
        ids = np.frombuffer(b"".join(keys), np.uint32)
        window = np.repeat(np.arange(len(keys)), np.array([len(k) // 4 for k in keys]))
        side_b = ids >= SIDE_B
        a, b, in_a, in_b = ids[~side_b], ids[side_b] - SIDE_B, window[~side_b], window[side_b]
        end_a, end_b = np.cumsum(self.spell_a.size[a]), np.cumsum(self.spell_b.size[b])
        # every stretch between neighbouring ends lies in one token of each side: a link
        ends = np.union1d(end_a, end_b)
        of_a, of_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        last_a, last_b = np.searchsorted(end_a, both), np.searchsorted(end_b, both)
        # groups as written: each group's A tokens, then its B tokens
        closes_a, closes_b, final = np.zeros(len(a), int), np.zeros(len(b), int), in_b[last_b] != np.append(in_b, -1)[last_b + 1]
        closes_a[last_a], closes_b[last_b] = 1, 1 + final
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        said = np.empty(len(ids), object)
        said[np.arange(len(a)) + np.repeat(np.cumsum(size_b) - size_b, size_a)] = self.said_a[closes_a, a]
        said[np.arange(len(b)) + np.repeat(np.cumsum(size_a), size_b)] = self.said_b[closes_b, b]
        said, to = said.tolist(), [0, *np.cumsum(np.bincount(window)).tolist()]
        links = np.bincount(in_a[of_a], minlength=len(keys))
        known, pairs = self.pair_no, (a[of_a].astype(np.int64) << 32 | b[of_b]).tolist()
        for pair in pairs:
            if pair not in known:
                known[pair] = len(self.pairs)
                self.pairs.append(pair)
        self.memo.update(zip(keys, range(len(self.text), len(self.text) + len(keys))))
        self.text += ["".join(said[i:j]) for i, j in zip(to, to[1:])]
        self.begin.extend((len(self.pair_of) + np.cumsum(links) - links).tolist())
        self.pair_of.extend(map(known.__getitem__, pairs))
        self.links.extend(links.tolist())
        self.groups.extend(np.bincount(in_a[last_a], minlength=len(keys)).tolist())
        self.held += len(ids)

    def cut(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First A and B token of each window of a chunk (its documents' tokens
        one after the other)."""
        size_a, size_b = self.spell_a.size[a], self.spell_b.size[b]
        start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        anchors = np.intersect1d(start_a[self.spell_a.spaced[a]], start_b[self.spell_b.spaced[b]], assume_unique=True)
        return np.searchsorted(start_a, anchors), np.searchsorted(start_b, anchors)

    def chunk(self, texts: list[str | None]) -> dict[str, pa.Array]:
        """Columns for the documents of a chunk."""
        if self.held > MEMO_IDS:
            self.empty()
        a, b = self.tokens(texts)
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        a, b = np.concatenate(a), np.concatenate(b)
        cut_a, cut_b = self.cut(a, b)
        # a window's ids one after the other, those of B marked
        ids = np.empty(len(a) + len(b), np.uint32)
        ids[np.arange(len(a)) + np.repeat(cut_b, np.diff(cut_a, append=len(a)))] = a
        ids[np.arange(len(b)) + np.repeat(np.append(cut_a, len(a))[1:], np.diff(cut_b, append=len(b)))] = b + SIDE_B
        raw, to = ids.tobytes(), [*(4 * (cut_a + cut_b)).tolist(), 4 * len(ids)]
        keys = [raw[i:j] for i, j in zip(to, to[1:])]
        if new := list(set(keys).difference(self.memo)):
            self.learn(new)
        codes = list(map(self.memo.__getitem__, keys))
        # a document begins with a space, so its first window begins with it
        first = np.searchsorted(cut_a, np.concatenate([[0], np.cumsum(n_a)]))
        at = first.tolist()
        code = np.array(codes, np.int64)
        groups, links = np.array(self.groups, np.int64)[code], np.array(self.links, np.int64)[code]
        total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[first])
        n_links = total(links)
        # every link's pair, numbered within the chunk, then counted by document
        inner = np.arange(links.sum()) - np.repeat(np.cumsum(links) - links, links)
        number = np.array(self.pair_of, np.int64)[np.repeat(np.array(self.begin, np.int64)[code], links) + inner]
        times = np.bincount(number, minlength=len(self.pairs))
        used = np.flatnonzero(times)
        place = np.zeros(len(times), np.int64)
        place[used] = np.arange(len(used))
        doc = np.repeat(np.arange(len(texts)), n_links)
        width = max(len(used), 1)
        seen, count = np.unique(doc * width + place[number], return_counts=True)
        ends = np.searchsorted(seen, np.arange(len(texts) + 1) * width)
        lists = lambda values, kind: pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array(values, kind))
        once = lambda values: pa.array([values] + [None] * (len(texts) - 1), pa.list_(pa.int64()))
        return {"n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(total(groups)),
                "n_links": pa.array(n_links),
                "groups": pa.array([";".join([self.text[c] for c in codes[i:j]]) for i, j in zip(at, at[1:])], pa.string()),
                "codes": lists(seen % width, pa.int32()), "times": lists(count, pa.int64()),
                "pairs": once(np.array(self.pairs, np.int64)[used]), "totals": once(times[used])}


def worker_aligner(path_a: str, path_b: str) -> Aligner:
    """The worker process's own ``Aligner``, kept in a module entry of the
    process so that a reused worker keeps its memo."""
    import types

    kept = sys.modules.setdefault("_pressroom_align", types.ModuleType("_pressroom_align")).__dict__
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = Aligner(path_a, path_b)
    return kept[path_a, path_b]


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per document: ``id, chunk, n_a, n_b, n_groups, n_links``,
    ``groups`` (``a1,a2|b1;a3|b2,b3``), its pairs' ``codes`` in the chunk's list
    and how many ``times`` each is linked; a chunk's first row has the list
    ``pairs`` (``A id << 32 | B id``) and their ``totals`` in the chunk."""
    path_a, path_b = path_a or default_tokenizer(), path_b or default_pieces()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, no = worker_aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            until = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            begin = 0
            while begin < len(texts):
                before = until[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(until, before + CHUNK_BYTES, "right")))
                columns = aligner.chunk(texts.slice(begin, end - begin).to_pylist())
                yield pa.RecordBatch.from_pydict({"id": ids.slice(begin, end - begin),
                                                  "chunk": pa.array([no] * (end - begin), pa.int64()), **columns})
                begin, no = end, no + 1

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, chunk long, n_a long, n_b long, n_groups long, n_links long, groups string, "
             "codes array<int>, times array<long>, pairs array<long>, totals array<long>")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, count, best`` over all rows of ``aligned``: links that hold the
    pair, and whether no other A id is linked more often to its B id."""
    counts = (rows.where(F.col("pairs").isNotNull()).select(F.explode(F.arrays_zip("pairs", "totals")).alias("x"))
              .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.totals").alias("count")))
    # a B id's partners are A ids, so a group has as many rows as A has ids at most
    top = F.max("count").over(Window.partitionBy(F.col("pair").bitwiseAND((1 << 32) - 1)))
    return counts.select("pair", "count", (F.col("count") == top).alias("best"))


def link_sums(rows: DataFrame, counts: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``n_best`` and ``count_sum`` of each row of ``aligned``."""
    lists = rows.where(F.col("pairs").isNotNull()).select(
        F.col("chunk").alias("of"), F.posexplode("pairs").alias("code", "pair"))
    weights = lists.join(counts, "pair").select("of", "code", "count", "best")
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)

    def sums(docs: pa.Table, weights: pa.Table) -> pa.Table:
        docs, weights = docs.combine_chunks(), weights.combine_chunks()
        code = weights["code"].to_numpy()
        count, best = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        count[code], best[code] = weights["count"].to_numpy(), weights["best"].to_numpy(zero_copy_only=False)
        own, times = (np.concatenate([x.flatten().to_numpy() for x in docs[c].chunks] or [np.zeros(0, np.int64)])
                      for c in ("codes", "times"))
        size = np.concatenate([[0], np.cumsum([len(x) for x in docs["codes"]])]).astype(np.int64)
        out = {c: docs[c] for c in keep}
        for name, weight in (("n_best", best), ("count_sum", count)):
            out[name] = pa.array(np.diff(np.concatenate([[0], np.cumsum(times * weight[own])])[size]), pa.int64())
        return pa.table(out)

    return (rows.select("chunk", *keep, "codes", "times").groupBy("chunk").cogroup(weights.groupBy("of"))
            .applyInArrow(sums, f"{kinds}, n_best long, count_sum long"))


def op11_token_align(spark, sf_dir):
    rows = aligned(read(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    rows = materialize(rows.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    counts = materialize(pair_counts(rows), "pair-counts")
    own = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    return link_sums(rows, counts, own).withColumnRenamed("id", "doc_id")
