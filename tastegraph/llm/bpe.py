"""Byte-level BPE: texts to ids by a vocabulary's ranks, and back to bytes.

A text is split by the vocabulary's pattern, and each match is encoded apart.  Two tiers:

1. A minimal perfect hash over the vocabulary (hash and displace, built once in numpy on the driver)
   gives each different match of a block one slot; the bytes kept for the slot decide whether it is that token.
2. What is no token is merged from single bytes: a linked list of parts and a heap of neighbouring pairs,
   lowest rank first and leftmost among equals, O(n log n) in the length of the match.

What travels to the tasks is the vocabulary (a few MB for any corpus).  Blocks are cut by characters, so memory follows the
longest text and not the batch.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

#: Mean keys in a bucket of the hash, and displacements tried at once.
LOAD, TRIALS = 4, 64
#: Matches whose ids a task remembers; more start it anew.
CACHED = 400_000
#: Characters of the texts that are encoded, and ids that are decoded, at once.
BLOCK = 1_000_000
M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def rank_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and number."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def scatter(h: np.ndarray, seed: np.ndarray, n: int) -> np.ndarray:
    """Slots of hashes under a displacement."""
    x = h + seed.astype(np.uint64) * M1
    x = (x ^ (x >> np.uint64(33))) * M2
    return ((x ^ (x >> np.uint64(29))) % np.uint64(n)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash of a fixed set of byte strings: as many slots as keys, none shared.

    Keys fall into buckets; a bucket, the fullest first, takes the first displacement that sends its keys
    to free slots.  A bucket of one key names its slot itself.
    """

    def __init__(self, keys: list[bytes]):
        if len(set(keys)) != len(keys):
            raise ValueError("keys repeat")
        self.n = len(keys)
        self.seeds = np.zeros(max(1, self.n // LOAD), np.int64)
        h = self.hashes(keys)
        bucket = self.buckets(h)
        sizes = np.bincount(bucket, minlength=len(self.seeds))
        members = np.split(np.argsort(bucket, kind="stable"), np.cumsum(sizes)[:-1])
        free = np.ones(self.n, bool)
        slot_of = np.empty(self.n, np.int64)
        order = np.argsort(-sizes, kind="stable")
        for b in order[sizes[order] > 1].tolist():
            own, first = h[members[b]], 0
            while True:
                seeds = np.arange(first, first + TRIALS)
                slots = scatter(own[None, :], seeds[:, None], self.n)
                ok = free[slots].all(axis=1)
                if len(own) == 2:
                    ok &= slots[:, 0] != slots[:, 1]
                else:
                    ok &= (np.diff(np.sort(slots, axis=1), axis=1) > 0).all(axis=1)
                if ok.any():
                    t = int(ok.argmax())
                    break
                first += TRIALS
            self.seeds[b] = seeds[t]
            slot_of[members[b]] = slots[t]
            free[slots[t]] = False
        left = np.flatnonzero(free)
        for b, slot in zip(order[sizes[order] == 1].tolist(), left.tolist(), strict=True):
            self.seeds[b] = -1 - slot
            slot_of[members[b]] = slot
        self.keys = [b""] * self.n
        for k, slot in zip(keys, slot_of.tolist()):
            self.keys[slot] = k

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        import xxhash
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def buckets(self, h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(7)) % np.uint64(len(self.seeds))).astype(np.int64)

    def slots(self, keys: list[bytes]) -> np.ndarray:
        """Slot of each key; -1 for what is not in the set."""
        if not self.n or not keys:
            return np.full(len(keys), -1, np.int64)
        h = self.hashes(keys)
        seed = self.seeds[self.buckets(h)]
        slot = np.where(seed < 0, -1 - seed, scatter(h, np.maximum(seed, 0), self.n))
        same = np.fromiter((self.keys[s] == k for s, k in zip(slot.tolist(), keys)), bool, len(keys))
        return np.where(same, slot, -1)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match that is no token: the neighbouring pair of lowest rank merges, the leftmost among equals."""
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # a part is [i, after[i])
    alive = [True] * n + [False]
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        middle = after[i]
        if not alive[i] or middle >= n or after[middle] != end:
            continue  # one of the pair has merged with another meanwhile
        alive[middle] = False
        after[i] = end
        if end < n:
            before[end] = i
            if (r := ranks.get(piece[i:after[end]])) is not None:
                heapq.heappush(heap, (r, i, after[end]))
        if (k := before[i]) >= 0 and (r := ranks.get(piece[k:end])) is not None:
            heapq.heappush(heap, (r, k, end))
    return [ranks[piece[i:after[i]]] for i in range(n) if alive[i]]


class Encoder:
    """Texts to ids, a block at a time."""

    def __init__(self, ranks: dict[bytes, int], pat: str):
        self.table = PerfectHash(list(ranks))
        self.ids = [ranks[k].to_bytes(4, "little") for k in self.table.keys]
        self.ranks, self.pat = ranks, pat
        self.known: dict[str, bytes] = {}
        self.split = None

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        import regex
        if self.split is None:
            self.split = regex.compile(self.pat).findall
        if len(self.known) > CACHED:
            self.known.clear()
        pieces = [self.split(t) for t in texts]
        new = list(set().union(*pieces).difference(self.known))
        raw = [p.encode("utf-8", "surrogatepass") for p in new]
        for piece, data, slot in zip(new, raw, self.table.slots(raw).tolist()):
            self.known[piece] = self.ids[slot] if slot >= 0 else np.array(merge(data, self.ranks), "<u4").tobytes()
        return [b"".join(map(self.known.__getitem__, p)) for p in pieces]


def blocks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours that sum up to about ``most``; at least one each."""
    lo, total = 0, 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > most:
            yield lo, i
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)


def listed(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4"), pa.int32()))


def encode(docs: DataFrame, path: str | None = None, pat: str | None = None) -> DataFrame:
    """``(doc_id, ids)``, a row per row of ``docs(doc_id, text)``.

    A null or empty text has no ids.  Rows without an id and repeated rows are encoded one by one; other
    columns are not read.  The vocabulary must hold every single byte.
    """
    own = Encoder(load_ranks(path or rank_file()), pat or pattern())

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in blocks([len(t) for t in texts], BLOCK):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), listed(own(texts[lo:hi]))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Add ``decoded``, the bytes of the ids, to ``(doc_id, ids)``; null ids are none.  An unknown id is an error."""
    ranks = load_ranks(path or rank_file())
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    lengths = np.array([len(t) for t in tokens], np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)])
    letters = np.frombuffer(b"".join(tokens), np.uint8)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(column), 0))
            for lo, hi in blocks(sizes.tolist(), BLOCK):
                part = column.slice(lo, hi - lo)
                ids = np.asarray(part.flatten())
                if len(ids) and not (0 <= ids.min() and ids.max() < len(tokens) and lengths[ids].min()):
                    raise ValueError("an id is not in the vocabulary")
                n = lengths[ids]
                ends = np.concatenate([[0], np.cumsum(n)])
                data = letters[np.arange(ends[-1]) + np.repeat(begins[ids] - ends[:-1], n)]
                at = ends[np.concatenate([[0], np.cumsum(sizes[lo:hi])])]
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), part, raw.cast(pa.binary())],
                                                 ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, ids array<int>, decoded binary")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = decode(encode(read(spark, sf_dir, "documents", "doc_id", "text")))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
