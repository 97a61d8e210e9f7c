"""Token ids of documents in compressed binary block files.

Documents are range-partitioned by id and sorted, so partition ``k`` is shard
``k`` of one ascending order. Each task tokenizes its documents with the
``tokenizers`` library, appends the end id, and packs whole documents into blocks
of about ``range_coder.BLOCK_IDS`` ids (a longer document is a block of its own).
A block is a row ``(shard, block, n_docs, n_ids, payload)`` of Parquet files; the
payload alone restores its documents (see ``range_coder``), is reset
independently and carries its checksum, so blocks are read in any order by any
task.

The library splits text by a fixed pattern and merges within the pieces, so a
piece always has the same ids; a bounded cache per Python worker keeps them, and
the library merges only pieces that are not cached. Documents are split, and their
ids put together, as arrays over a run of documents. Texts that hold an added
token's string go through the library whole.

A null text counts as empty (one end id); a null id sorts first; repeated
documents are written one by one; extra columns are ignored; an empty table gives
no blocks.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pressroom.llm import range_coder
from pressroom.llm.common import partitions, read
from pressroom.sources.staging import staging_path

END_ID = 2
CACHE_PIECES = 400_000      # some 80 MB a worker
CHUNK_CHARS = 1 << 20
#: Fixed value: the pattern that splits text before byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# The same split in the standard library's terms, which is faster. On the
# characters of PLAIN (Latin letters, ASCII, common punctuation and signs) its
# classes agree with the property classes above; a test walks through them.
PLAIN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"""
PLAIN = "\t\n\r -~\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


OTHER, SPACE, LETTER, NUMBER, END = range(5)
PLANE = 1 << 16


def character_kinds(first: int) -> np.ndarray:
    """The classes in ``PATTERN`` of the 2^16 code points from ``first`` on, as the
    library's own engine has them (engines differ in the latest Unicode versions)."""
    from tokenizers import Regex, pre_tokenizers

    kinds = np.full(PLANE, OTHER, dtype=np.uint8)
    cuts = [(kind, pre_tokenizers.Split(Regex(run), "removed", invert=True))
            for kind, run in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"))]
    for at in range(0, PLANE, 1 << 11):
        if not 0xD800 <= first + at < 0xE000:
            text = "".join(map(chr, range(first + at, first + at + (1 << 11))))
            for kind, cut in cuts:
                for _, (a, b) in cut.pre_tokenize_str(text):
                    kinds[at + a:at + b] = kind
    return kinds


class Pieces:
    """Token ids of texts, with the ids of frequent pieces kept."""

    def __init__(self, path: str):
        import json
        import os
        import re

        import regex
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        self.by_piece = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                         and not spec["normalizer"] and not spec["post_processor"])
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.plain = re.compile(f"[{PLAIN}]*").fullmatch
        self.split_plain, self.split_any = re.compile(PLAIN_PATTERN).findall, regex.compile(PATTERN).findall
        self.kinds = character_kinds(0)     # further planes when a text has them
        # pieces of one run of texts, and those that came again
        self.fresh: dict[bytes, bytes] = {}
        self.kept: dict[bytes, bytes] = {}
        # byte-level letters: visible Latin-1 characters stand for themselves, the
        # other bytes for the characters from U+0100 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
        self.letters = np.arange(256, dtype="<u4")
        hidden = sorted(set(range(256)).difference(shown))
        self.letters[hidden] = 256 + np.arange(len(hidden))

    def split(self, text: str) -> list[str]:
        """The pieces of one text by the pattern itself. ``cuts`` gives the same for many
        texts (but for letters that are newer than the library's)."""
        return (self.split_plain if self.plain(text) else self.split_any)(text)

    def cuts(self, texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """(the texts in UTF-8, each with one more character; where pieces begin in
        it, and its length; the places among the pieces of those characters)."""
        joined = "\0".join(texts) + "\0"
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        data = joined.encode()
        ascii_only = len(data) == len(joined)
        code = np.frombuffer(data, dtype=np.uint8) if ascii_only else np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        while code.max() >= len(self.kinds):
            self.kinds = np.concatenate([self.kinds, character_kinds(len(self.kinds))])
        kind = self.kinds[code]
        kind[ends] = END
        n = len(kind)
        begins = np.ones(n + 1, dtype=bool)
        # runs of one class; a run of white space leaves its last character to what
        # follows, which takes it in if it is a space
        begins[1:n] = kind[1:] != kind[:-1]
        begins[ends] = begins[ends + 1] = True
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != END))
        begins[last] = True
        begins[last[code[last] == ord(" ")] + 1] = False
        # 's 't 'm 'd 're 've 'll, where a piece begins with the apostrophe
        quote = np.flatnonzero(code == ord("'"))
        quote = quote[begins[quote] & (kind[quote + 1] == LETTER)]
        one, two = code[quote + 1], code[np.minimum(quote + 2, n - 1)]
        short, long = np.isin(one, [ord(c) for c in "stmd"]), np.zeros(len(quote), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        begins[quote[short | long] + 1] = False
        begins[quote[short] + 2] = True
        begins[quote[long] + 3] = True
        starts = np.flatnonzero(begins)
        places = np.searchsorted(starts, ends)
        if not ascii_only:
            first = np.flatnonzero(np.frombuffer(data, dtype=np.int8) >= -64)   # each character's first byte
            starts = np.append(first[starts[:-1]], len(data))
        return data, starts, places

    def whole(self, texts: list[str]) -> list[bytes]:
        return [self.pack(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of single pieces, by the library's model alone."""
        merge, pack = self.library.model.tokenize, self.pack
        shown = self.letters[np.frombuffer(b"".join(pieces), dtype=np.uint8)].tobytes().decode("utf-32-le")
        ends = list(accumulate(map(len, pieces)))
        return [pack([t.id for t in merge(shown[a:b])]) for a, b in zip([0, *ends], ends)]

    def known(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of different pieces; those that are not cached are merged."""
        found = list(map(self.kept.get, pieces))
        gaps, new = [k for k, ids in enumerate(found) if ids is None], []
        for k in gaps:
            if (ids := self.fresh.pop(pieces[k], None)) is None:
                new.append(k)
            else:
                found[k] = self.kept[pieces[k]] = ids
        merged = self.merged([pieces[k] for k in new])
        for k, ids in zip(new, merged):
            found[k] = self.fresh[pieces[k]] = ids
        if len(self.fresh) + len(self.kept) > CACHE_PIECES:
            # what came once goes; when what came again takes half, it has to come again
            self.fresh, self.kept = (self.kept, {}) if len(self.kept) > CACHE_PIECES // 2 else ({}, self.kept)
        return found

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        numbers = array("I", ids)
        if sys.byteorder == "big":
            numbers.byteswap()
        return numbers.tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if not self.by_piece or not texts:
            return self.whole(texts)
        plain = [not any(a in t for a in self.added) for t in texts]
        data, starts, places = self.cuts([t if ok else "" for t, ok in zip(texts, plain)])
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)]).dictionary_encode()
        ids = self.known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.array([*map(len, ids), 0]) // 4
        piece = np.array(coded.indices)
        piece[places] = len(ids)    # the characters between texts have no ids
        count = sizes[piece]
        stop = np.cumsum(count)
        first = (np.cumsum(sizes) - sizes)[piece] - (stop - count)
        raw = np.frombuffer(b"".join(ids), dtype="<u4")[np.arange(stop[-1]) + np.repeat(first, count)].tobytes()
        ends = (4 * stop[places]).tolist()
        return [raw[a:b] if ok else self.whole([t])[0] for t, ok, a, b in zip(texts, plain, [0, *ends], ends)]


def worker_pieces(path: str) -> Pieces:
    """The worker process's own ``Pieces``. This package's functions are sent by
    value with every task, module state included; a module entry of the process
    outlives the task, so a reused worker keeps its cache."""
    import types

    kept = sys.modules.setdefault("_pressroom_worker", types.ModuleType("_pressroom_worker")).__dict__
    if path not in kept:
        kept[path] = Pieces(path)
    return kept[path]


def _chunks(batch: pd.DataFrame) -> Iterator[tuple[list, list[str]]]:
    """Runs of a batch's rows of about CHUNK_CHARS characters."""
    ids, texts, size = [], [], 0
    for i, t in zip(batch["id"].tolist(), batch["text"]):
        ids.append(None if i is None else int(i))
        texts.append(t)
        size += len(t)
        if size >= CHUNK_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", shards: int | None = None, end_id: int = END_ID) -> str:
    """Write the documents' ids under ``path`` in ascending id order."""
    tokenizer = tokenizer or default_tokenizer()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = worker_pieces(tokenizer)
        shard, block, end = TaskContext.get().partitionId(), 0, np.array([end_id], dtype="<u4").tobytes()
        ids: list = []
        parts: list[bytes] = []
        held_ids = 0

        def close() -> pd.DataFrame:
            nonlocal block, ids, parts, held_ids
            sizes = [len(p) // 4 for p in parts]
            payload = range_coder.pack_block(ids, sizes, np.frombuffer(b"".join(parts), dtype="<u4"))
            row = pd.DataFrame({"shard": [shard], "block": [block], "n_docs": [len(ids)], "n_ids": [sum(sizes)],
                                "payload": [payload]})
            block, ids, parts, held_ids = block + 1, [], [], 0
            return row

        for batch in batches:
            for names, texts in _chunks(batch):
                for name, got in zip(names, pieces.encode(texts)):
                    got += end
                    if ids and held_ids + len(got) // 4 > range_coder.BLOCK_IDS:
                        yield close()
                    ids.append(name)
                    parts.append(got)
                    held_ids += len(got) // 4
        if ids:
            yield close()

    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    (rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(shards or partitions(spark), "id", "tie")
     .sortWithinPartitions("id", "tie", "text")
     # as strings: pandas would make numbers beside a null inexact
     .select(F.col("id").cast("string").alias("id"), "text")
     .mapInPandas(encode, "shard int, block int, n_docs long, n_ids long, payload binary")
     .write.mode("overwrite").parquet(path))
    return path


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every document of
    the files, decoded block by block."""
    files = spark.read.parquet(path)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, block, payload in zip(batch["shard"], batch["block"], batch["payload"]):
                names, sizes, ids = range_coder.unpack_block(bytes(payload))
                ends = np.cumsum(sizes, dtype=np.int64)
                raw = ids.tobytes()
                cut = [raw[4 * (e - s):4 * e] for s, e in zip(sizes.tolist(), ends.tolist())]
                out = {"shard": shard, "block": block, "doc_id": pd.array(names, dtype="Int64"),
                       "skip": ends - sizes, "n_tokens": sizes.astype(np.int64),
                       "ids_crc32": np.array([zlib.crc32(c) for c in cut], dtype=np.int64)}
                if with_ids:
                    out["ids"] = [np.frombuffer(c, dtype="<u4").astype(np.int32) for c in cut]
                yield pd.DataFrame(out)

    docs = files.select("shard", "block", "payload").mapInPandas(
        decode, "shard int, block int, doc_id long, skip long, n_tokens long, ids_crc32 long"
        + (", ids array<int>" if with_ids else ""))
    blocks = files.select("shard", "block", "n_ids")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shard: as many as the writer had partitions
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("shard_start"))
    starts = (blocks.select("shard", "block", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("block_start"))
              .join(shards, "shard"))
    return docs.join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("shard_start") + F.col("block_start") + F.col("skip")).alias("start"),
        "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def token_table(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` to a fresh folder and read the files back."""
    path = staging_path(docs.sparkSession, "tokens")
    return read_tokens(docs.sparkSession, write_tokens(docs, path, **options))


def op9_token_files(spark, sf_dir):
    return token_table(read(spark, sf_dir, "documents"))
