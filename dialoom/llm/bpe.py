"""Encoding of a corpus with a public byte-level BPE tokenizer.

Each word keeps a contiguous array of part boundaries and of the ranks of
adjacent pairs. The smallest rank is found by a scan, its right boundary is
deleted and the two neighbouring ranks are refreshed, until no pair has a rank.
Long words (where rescanning would be quadratic) take the same merges in the
same order from a heap. Words repeat, so each worker keeps a bounded memo.

Defined results: NULL and empty texts give an empty list; text that looks like
a special token is ordinary text; texts of any length are encoded whole; one
row out per row in, ids and order as in the input.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

TOKENIZER_DIR = "/opt/tokenizers"
# Fixed value: the pattern that cuts text into words before the merges.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
SHORT_WORD = 128
MEMO_WORDS = 200_000
NONE = 1 << 30


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """The ranks of a rank file: base64 token and rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}


def merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word by scanning the contiguous rank array."""
    n = len(word)
    starts = list(range(n + 1))
    pair = [ranks.get(word[i : i + 2], NONE) for i in range(n - 1)]
    while pair:
        low = min(pair)
        if low == NONE:
            break
        i = pair.index(low)
        del starts[i + 1]
        del pair[i]
        if i < len(pair):
            pair[i] = ranks.get(word[starts[i] : starts[i + 2]], NONE)
        if i:
            pair[i - 1] = ranks.get(word[starts[i - 1] : starts[i + 1]], NONE)
    return [ranks[word[a:b]] for a, b in zip(starts, starts[1:])]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges from a heap, for words where scans would be quadratic."""
    n = len(word)
    nxt, prv, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or nxt[i] >= n or end[nxt[i]] != stop:
            continue
        j = nxt[i]
        alive[j] = False
        end[i], nxt[i] = stop, nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
            if (r := ranks.get(word[i : end[nxt[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[nxt[i]]))
        if (p := prv[i]) >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = nxt[i]
    return out


class Encoder:
    """Text to ids; one per worker process."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.memo: dict[str, list[int]] = {}

    def word(self, word: str) -> list[int]:
        got = self.memo.get(word)
        if got is None:
            raw = word.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(raw)
            if whole is not None:
                got = [whole]
            else:
                got = merge_short(raw, self.ranks) if len(raw) <= SHORT_WORD else merge_long(raw, self.ranks)
            if len(raw) <= SHORT_WORD:
                if len(self.memo) >= MEMO_WORDS:
                    self.memo.clear()
                self.memo[word] = got
        return got

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        word, memo = self.word, self.memo
        for w in WORD.findall(text):
            out += memo.get(w) or word(w)
        return out

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        word, memo = self.word, self.memo
        return sum(len(memo.get(w) or word(w)) for w in WORD.findall(text))


_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str, raw: Broadcast) -> Encoder:
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(read_ranks(raw.value))
    return _ENCODERS[name]


def rank_file(spark: SparkSession, tokenizer: str, directory: str = TOKENIZER_DIR) -> Broadcast:
    """The bytes of a vocabulary (a fixed file of under 2 MB) for the workers."""
    with open(os.path.join(directory, f"{tokenizer}.tiktoken"), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where the input comes in fewer splits than cores.

    Larger inputs have more splits than that and aren't shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def encode_corpus(docs: DataFrame, tokenizer: str = "byte_bpe_50k", directory: str = TOKENIZER_DIR) -> DataFrame:
    """doc_id and ids (array<int>) of each row of ``docs`` (doc_id, text)."""
    raw = rank_file(docs.sparkSession, tokenizer, directory)
    key = f"{directory}/{tokenizer}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(key, raw)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                ids = pa.array([enc.encode(t) for t in part.column(1).to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return spread(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def count_tokens(docs: DataFrame, tokenizer: str, directory: str = TOKENIZER_DIR) -> DataFrame:
    """doc_id and n_tokens of each row of ``docs`` (doc_id, text)."""
    raw = rank_file(docs.sparkSession, tokenizer, directory)
    key = f"{directory}/{tokenizer}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(key, raw)
        for b in batches:
            n = pa.array([enc.count(t) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n], ["doc_id", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return spread(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, n_tokens bigint")
