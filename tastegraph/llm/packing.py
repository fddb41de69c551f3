"""Best-two-fit packing of tokenized documents into sequences.

Only lengths decide how pieces go together, and there are no more lengths than a sequence
has tokens.  So the driver plans on the counts per length (at most 1,023 numbers, however
large the corpus): a bin is filled greedily with the longest pieces that fit, then
its smallest piece is exchanged for the two unpacked ones that fit the wider gap most
tightly.  A bin is used as many times at once as the counts allow.  The tasks then number the
pieces of each length and look up bin and offset in that plan.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import numbered
from ..session import materialize
from .common import per_worker, read

CAPACITY = 1024
END_ID = 2
#: Words kept in the encoder's cache of a Python worker; more start it anew.
CACHED_WORDS = 400_000
#: Marks that, after letters, are an atom of their own.
MARKS = list(".,;:!?")


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Texts to their ids as little-endian 32-bit numbers.

    The vocabulary's splitter never joins what stands on either side of one space between
    two non-spaces, so a text is encoded word by word (each with its space in front) and
    repeated words come from a cache.  New words are cut by the splitter's pattern (letters are one
    atom, a mark after them another).  New atoms are encoded many at a time, one a line, by the same
    vocabulary's ranks, which is several times as fast.  A text with two spaces in a row, or with a
    marker of a special token, is encoded whole.
    """
    import numpy as np
    import public_tokenizers
    import regex
    import tiktoken
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    letter = byte_letters()
    special_ids = set(own.get_added_tokens_decoder())
    ranks = tiktoken.Encoding("atoms", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
        bytes(letter[c] for c in token): i for token, i in vocabulary.items() if i not in special_ids})
    special = [t.content for t in own.get_added_tokens_decoder().values()]
    atoms_of = regex.compile(public_tokenizers.PATTERN).findall
    line_end = own.encode("\n", add_special_tokens=False).ids[0]
    words_known: dict[str, bytes] = {}
    atoms_known: dict[str, bytes] = {}

    def whole(text: str) -> bytes:
        return np.array(own.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encoded(atoms: list[str]) -> Iterator[bytes]:
        """Ids of atoms that are not white space, many in one text, one a line."""
        for at in range(0, len(atoms), 500):
            ids = np.array(ranks.encode_ordinary("\n".join(atoms[at:at + 500])), "<u4")
            raw, begin = ids.tobytes(), 0
            for end in [*np.flatnonzero(ids == line_end).tolist(), len(ids)]:
                yield raw[4 * begin:4 * end]
                begin = end + 1

    def add(known: dict[str, bytes], keys: list[str], atoms: list[str]) -> None:
        known.update(zip(keys, encoded(atoms), strict=True))

    def learn(words: set[str]) -> None:
        """Take in words that follow a space: letters, letters and a mark, and all others by their atoms."""
        letters, marked, others = [], [], {}
        for w in words:
            if w.isalpha():
                letters.append(w)
            elif w[-1] in MARKS and w[:-1].isalpha():
                marked.append(w)
            else:
                others[w] = atoms_of(" " + w)
        stems = list({w[:-1] for w in marked}.union(letters).difference(words_known))
        add(words_known, stems, [" " + w for w in stems])
        learn_atoms([*others.values(), MARKS])
        for w in marked:
            words_known[w] = words_known[w[:-1]] + atoms_known[w[-1]]
        for w, atoms in others.items():
            words_known[w] = b"".join(map(atoms_known.__getitem__, atoms))

    def learn_atoms(found: list[list[str]]) -> None:
        new = list(set().union(*found).difference(atoms_known))
        atoms_known.update((a, whole(a)) for a in new if not a.strip())
        new = [a for a in new if a.strip()]
        add(atoms_known, new, new)

    def encode(texts: list[str]) -> list[bytes]:
        if len(words_known) > CACHED_WORDS:
            words_known.clear()
        if len(atoms_known) > CACHED_WORDS:
            atoms_known.clear()
        split = [t.split(" ") for t in texts]
        plain = ["" not in w and not any(s in t for s in special) for t, w in zip(texts, split)]
        firsts = [atoms_of(w[0]) if ok else [] for w, ok in zip(split, plain)]
        learn_atoms(firsts)
        after = [w[1:] if ok else [] for w, ok in zip(split, plain)]
        learn(set().union(*after).difference(words_known))
        return [b"".join([*map(atoms_known.__getitem__, first), *map(words_known.__getitem__, words)])
                if ok else whole(t) for t, first, words, ok in zip(texts, firsts, after, plain)]

    return encode


def cut(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of ``docs(doc_id, text)``.

    A null text is an empty one: the end id alone.  What is longer than ``capacity`` is cut so
    that all pieces but the first are full.  Repeated rows are cut one by one.
    """
    path = path or vocabulary()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, end = per_worker(("encoder", path), lambda: encoder(path)), end_id.to_bytes(4, "little")
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.iloc[lo:lo + 256]
                texts = ["" if t is None else t for t in part["text"]]
                rows = []
                for doc_id, ids in zip(part["doc_id"], encode(texts)):
                    ids += end
                    n = len(ids) // 4
                    at, k = 0, 0
                    while at < n:
                        size = capacity if (n - at) % capacity == 0 else (n - at) % capacity
                        rows.append((doc_id, k, at, size, zlib.crc32(memoryview(ids)[4 * at:4 * (at + size)])))
                        at, k = at + size, k + 1
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype(
                    {"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(pieces, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Bins for ``counts`` pieces per length (below capacity): how often, and which lengths."""
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left, reverse=True)
    bins = []
    while lengths:
        used: dict[int, int] = {}
        free = lambda n: left[n] - used.get(n, 0)
        gap, fill = capacity, []
        for n in lengths:  # greedily, the longest first
            while n <= gap and free(n) > 0:
                fill.append(n)
                used[n] = used.get(n, 0) + 1
                gap -= n
        if gap and len(fill) > 1:
            small = fill[-1]
            used[small] -= 1
            best, pair = small, None
            stock = [n for n in lengths if n < gap + small and free(n) > 0 and n != small
                     or n == small and free(n) > 1]
            low, high = len(stock) - 1, 0
            while high <= low:  # longest and shortest walk towards each other
                a, b = stock[high], stock[low]
                if a + b > gap + small:
                    high += 1
                    continue
                if a + b > best and (high < low or free(a) > 1):
                    best, pair = a + b, (a, b)
                low -= 1
            for n in pair or (small,):
                used[n] = used.get(n, 0) + 1
            fill[-1:] = pair or (small,)
        times = min(left[n] // k for n, k in used.items() if k)
        bins.append((times, sorted(fill, reverse=True)))
        for n, k in used.items():
            left[n] -= k * times
        lengths = [n for n in lengths if left[n] > 0]
    return bins


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows of :func:`cut`.

    The plan has a row per bin kind and length.  A step of the planner uses up
    a length or leaves fewer of it than one bin takes (at most ``capacity / length``, halving each
    time), so kinds are bounded by the capacity and not by the data; it is broadcast.
    """
    spark = pieces.sparkSession
    pieces = materialize(pieces, "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(n > capacity or n < 1 for n in counts):
        raise ValueError("a piece is empty or longer than a sequence")
    rows, base, taken = [], 0, {}
    full = counts.pop(capacity, 0)
    if full:
        rows.append((capacity, 0, full, base, 1, 0))
        base += full
    for times, fill in plan(counts, capacity):
        at = 0
        for n in sorted(set(fill), reverse=True):
            k, first = fill.count(n), taken.get(n, 0)
            rows.append((n, first, first + k * times, base, k, at))
            taken[n] = first + k * times
            at += n * k
        base += times
    kinds = spark.createDataFrame(
        rows, "_length long, _first long, _end long, _base long, _per long, _offset long")
    ranked = numbered(pieces, ["length"], ["doc_id", "piece"], "pieces-order")
    at = F.col("rank") - 1
    step = at - F.col("_first")
    return (ranked.join(F.broadcast(kinds), (F.col("length") == F.col("_length")) & (at >= F.col("_first"))
                        & (at < F.col("_end")))
            .select(*pieces.columns,
                    (F.col("_base") + F.floor(step / F.col("_per"))).cast("long").alias("sequence_id"),
                    (F.col("_offset") + F.pmod(step, F.col("_per")) * F.col("length")).cast("long").alias("offset")))


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(cut(read(spark, sf_dir, "documents", "doc_id", "text")))
