"""Byte-level BPE in two tiers.

A minimal perfect hash over the vocabulary resolves a whole pre-token that is a vocabulary entry.
Any other pre-token is merged from its bytes, kept as a doubly linked list, with a heap of
candidate merges ordered by rank and then by place.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from malgeul.llm.common import give_back, require

#: Pre-tokens whose ids a worker keeps, in two generations of half as many, and pairs of ids.
CACHE = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a .tiktoken file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """Hash and displace: keys fall into buckets; each bucket, largest first, gets the first seed that
    sends all its keys to free slots of a table with exactly one slot per key."""

    def __init__(self, ranks: dict[bytes, int], load: int = 4):
        n = len(ranks)
        self.seeds = np.zeros(max(1, -(-n // load)), np.int64).tolist()
        self.keys: list[bytes] = [b""] * n
        self.ranks: list[int] = [-1] * n
        buckets: list[list[tuple[int, bytes]]] = [[] for _ in self.seeds]
        for key in ranks:
            h = xxhash.xxh3_64_intdigest(key)
            buckets[h % len(buckets)].append((h, key))
        free = [True] * n
        for b in sorted(range(len(buckets)), key=lambda b: -len(buckets[b])):
            if not buckets[b]:
                break
            for seed in itertools.count(1):
                slots = {self._slot(h, seed, n) for h, _ in buckets[b]}
                if len(slots) == len(buckets[b]) and all(free[s] for s in slots):
                    break
            self.seeds[b] = seed
            for h, key in buckets[b]:
                s = self._slot(h, seed, n)
                free[s], self.keys[s], self.ranks[s] = False, key, ranks[key]

    @staticmethod
    def _slot(h: int, seed: int, n: int) -> int:
        x = (h ^ (seed * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
        x = ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        return (x >> 32) * n >> 32

    def get(self, key: bytes) -> int:
        """The key's rank, or -1."""
        if not self.keys:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        s = self._slot(h, self.seeds[h % len(self.seeds)], len(self.keys))
        return self.ranks[s] if self.keys[s] == key else -1


class Pairs:
    """Ranks of joined pairs of ids, -1 for none; the perfect hash is asked once for each pair."""

    def __init__(self, rank_of, bytes_of: dict[int, bytes]):
        self.rank_of, self.bytes_of = rank_of, bytes_of
        self.known: dict[int, int] = {}

    def ask(self, key: int) -> int:
        """The rank for ``left << 32 | right``."""
        if len(self.known) >= CACHE:
            self.known.clear()
        rank = self.known[key] = self.rank_of(self.bytes_of[key >> 32] + self.bytes_of[key & 0xFFFFFFFF])
        return rank


def merge_bytes(ids: list[int], pairs: Pairs) -> list[int]:
    """Join ids, at first those of single bytes: again and again the adjacent pair of lowest rank, leftmost first.

    A heap entry, rank and place in one number, is void if the pair that now begins there has another rank.
    """
    n = len(ids)
    token, left, right = list(ids), list(range(-1, n - 1)), list(range(1, n + 1))
    known, ask = pairs.known.get, pairs.ask
    heap = []
    for i in range(n - 1):
        key = token[i] << 32 | token[i + 1]
        if (r := known(key, -2)) == -2:
            r = ask(key)
        if r >= 0:
            heap.append(r << 32 | i)
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        entry = pop(heap)
        i, rank = entry & 0xFFFFFFFF, entry >> 32
        j = right[i]
        if token[i] < 0 or j >= n:
            continue
        key = token[i] << 32 | token[j]
        if (r := known(key, -2)) == -2:
            r = ask(key)
        if r != rank:
            continue
        token[i], token[j] = r, -1  # not the equal rank of the entry, which would be a number of its own in each result that is kept
        k = right[i] = right[j]
        if k < n:
            left[k] = i
            key = rank << 32 | token[k]
            if (r := known(key, -2)) == -2:
                r = ask(key)
            if r >= 0:
                push(heap, r << 32 | i)
        h = left[i]
        if h >= 0:
            key = token[h] << 32 | rank
            if (r := known(key, -2)) == -2:
                r = ask(key)
            if r >= 0:
                push(heap, r << 32 | h)
    return [t for t in token if t >= 0]


@lru_cache
def _splitters(pattern: str):
    """The pattern, and an equal one for ASCII texts that the standard library runs faster."""
    ascii_form = pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").replace(" ?A-Za-z+", " ?[A-Za-z]+").replace(" ?0-9+", " ?[0-9]+")
    return regex.compile(pattern), None if r"\p" in ascii_form else re.compile(ascii_form, re.ASCII)


class Codec:
    """Encoder and decoder over one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.index, self.pattern = PerfectHash(ranks), pattern
        self.bytes_of: dict[int, bytes] = {rank: token for token, rank in ranks.items()}
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.pairs = Pairs(self.index.get, self.bytes_of)
        self.cache: dict[str, tuple[int, ...]] = {}
        self.before: dict[str, tuple[int, ...]] = {}

    def piece(self, token: str) -> tuple[int, ...]:
        """The ids of a pre-token.  A full cache becomes the generation before, whose pre-tokens move on as they are met again: the rare ones go."""
        ids = self.cache.get(token) or self.before.get(token)
        if ids is None:
            raw = token.encode()
            rank = self.index.get(raw)
            ids = (rank,) if rank >= 0 else tuple(merge_bytes([self.single[b] for b in raw], self.pairs))
        if len(self.cache) >= CACHE // 2:
            self.before, self.cache = self.cache, {}
        if len(token) <= 64:
            self.cache[token] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        wide, narrow = _splitters(self.pattern)
        tokens = (narrow if narrow and text.isascii() else wide).findall(text)
        known, piece = self.cache.get, self.piece
        return list(itertools.chain.from_iterable([known(t) or piece(t) for t in tokens]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def encode(docs: DataFrame, codec: Codec | Broadcast) -> DataFrame:
    """``doc_id`` and ``ids array<int>`` of every row's whole ``text``; null and empty texts have no ids.
    Rows keep their number and order within a partition; other columns are ignored."""
    require(docs, "doc_id", "text")
    shared = codec if isinstance(codec, Broadcast) else docs.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            ids = [np.asarray(own.encode(t or ""), np.int32) for t in batch["text"].to_pylist()]
            offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, codec: Codec | Broadcast) -> DataFrame:
    """``doc_id`` and the ``data binary`` that its ``ids`` stand for; null and empty ids give empty data, ids that the vocabulary
    lacks, null among them, give null.  Repeated rows are all decoded; other columns are ignored; an empty table gives no rows."""
    require(encoded, "doc_id", "ids")
    shared = codec if isinstance(codec, Broadcast) else encoded.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value

        def data_of(ids: list | None) -> bytes | None:
            try:
                return own.decode(ids or [])
            except KeyError:
                return None

        for batch in batches:
            data = [data_of(ids) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(data, pa.binary())], ["doc_id", "data"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, data binary")


def round_trip(docs: DataFrame, codec: Codec | Broadcast, keep: tuple[str, ...] = ()) -> DataFrame:
    """Encode and decode in one pass: ``doc_id, n_tokens``, digests of the ids and of the decoded bytes of every row, and the columns ``keep``.

    Null and empty texts have no tokens; repeated rows and null ids are coded row by row, very long texts whole; other columns
    are ignored; an empty table gives no rows."""
    require(docs, "doc_id", "text", *keep)
    shared = codec if isinstance(codec, Broadcast) else docs.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        own = shared.value
        digits = {rank: str(rank) for rank in own.bytes_of}
        for batch in batches:
            n, shas, backs = [], [], []
            for text in batch["text"]:
                ids = own.encode(text.as_py() or "")
                n.append(len(ids))
                shas.append(hashlib.sha256(" ".join(map(digits.__getitem__, ids)).encode()).hexdigest())
                backs.append(hashlib.sha256(own.decode(ids)).hexdigest())
            out = [batch["doc_id"], pa.array(n, pa.int64()), pa.array(shas, pa.string()), pa.array(backs, pa.string())]
            yield pa.RecordBatch.from_arrays(out + [batch[c] for c in keep], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *keep])

    kind = docs.schema["doc_id"].dataType.simpleString()
    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select("doc_id", "text", *(F.col(c) for c in keep)).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
