"""Phrases whose words stand together more often than apart.

Texts are hashed, never shuffled.  A task writes the words of a block one behind the other with one space between,
and takes prefix sums of ``byte * base**place`` modulo a prime (numpy); the Rabin-Karp fingerprint of any n-gram is then one
difference.  Two primes make the 62 bits of a key, a third a check value; the language goes
into both.  What is shuffled is a row per key and block: a count, the sum of the check values, and a pointer to one
occurrence (document, first byte, length).

An n-gram can only be frequent if the two (n-1)-grams in it are.  The frequent keys of one length are put into a bit
table of fixed size, and the next length counts only what passes it.  The table may let too much
through (more so when it fills up) but never too little, so counts stay exact at any size.

Only frequent keys are looked up in the texts.  Their phrase has to give the key again, and its check value times the count has to be the
sum of all check values.  Where it doesn't, different phrases share the key, and the n-grams of that key
are counted once more by their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import top_k
from ..session import materialize
from .common import read

#: Bytes that separate words, and bytes that end a piece.
SPACES, BREAKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
MOST_WORDS, LEAST, ABSORBED, FIRST = 3, 10, 50, 2000
UNKNOWN = "und"
#: Moduli of the key, that of the check value (small, so that sums stay in 64 bits), and the base.
PRIMES, CHECK, BASE = (2**31 - 1, 2_147_483_629), 1_048_573, 1_000_003
#: Bytes hashed at once; only a longer piece makes a larger block.
BLOCK = 1 << 20
#: Bits of the table of frequent keys as a power of two, and places per key.
BITS, PLACES = 26, 2
ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo a prime below 2**31, by doubling."""
    out = np.ones(n, np.uint32)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more].astype(np.uint64) * np.uint64(pow(base, have, prime)) % np.uint64(prime)
        have += more
    return out


class Polynomial:
    """Fingerprints of substrings modulo one prime."""

    def __init__(self, prime: int):
        self.prime = np.uint64(prime)
        self.up = self.down = np.ones(1, np.uint32)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            n = max(BLOCK, len(data)) + 2
            self.up = powers(BASE, int(self.prime), n)
            self.down = powers(pow(BASE, -1, int(self.prime)), int(self.prime), n)
        terms = self.up[:len(data)] * (data.astype(np.uint64) + np.uint64(1))
        if len(data) >= 1 << 23:  # 40 bits a term: the sum of more could pass 63
            terms %= self.prime
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])

    def of(self, prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[begin]) % self.prime * self.down[begin] % self.prime

    def whole(self, raw: bytes) -> int:
        data = np.frombuffer(raw, np.uint8)
        return int(self.of(self.prefixes(data), np.zeros(1, np.int64), np.array([len(data)]))[0])


class Hasher:
    """Keys and check values of n-grams within the pieces of texts."""

    def __init__(self):
        self.polynomials = [Polynomial(p) for p in (*PRIMES, CHECK)]
        self.langs: dict[str, list[int]] = {}
        self.kind = np.zeros(256, np.uint8)
        self.kind[list(SPACES)] = 1
        self.kind[list(BREAKS)] = 2
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32

    def of_lang(self, lang: str) -> list[int]:
        if lang not in self.langs:
            self.langs[lang] = [p.whole(lang.encode() + b"\xff") * 31 % int(p.prime) for p in self.polynomials]
        return self.langs[lang]

    def phrase(self, lang: str, phrase: str) -> tuple[int, int]:
        one, two, check = ((p.whole(phrase.encode("utf-8", "surrogatepass")) + own) % int(p.prime)
                           for p, own in zip(self.polynomials, self.of_lang(lang)))
        return one << 31 | two, check

    def grams(self, raw: bytes, starts: np.ndarray, langs: list[str], n: int, table: np.ndarray | None):
        """``(document, begin, end, key, check)`` arrays of the n-grams of a block of documents.

        ``starts`` are the first bytes of the documents in ``raw``.  ``table``: bits that the keys of both
        (n-1)-grams must have.
        """
        data = self.lower[np.frombuffer(raw, np.uint8)]
        kind = self.kind[data]
        word = kind == 0
        edge = np.zeros(len(data) + 1, bool)
        edge[starts] = True
        begins = word.copy()
        begins[1:] &= ~word[:-1] | edge[1:-1]
        ends = word.copy()
        ends[:-1] &= ~word[1:] | edge[1:-1]
        begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        doc = np.searchsorted(starts, begin, side="right") - 1
        piece = np.cumsum(kind == 2)[begin] + doc
        sizes = end - begin
        place = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes + 1)])[:-1]  # of a word in the text of words
        joined = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
        joined[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = data[word]
        prefixes = [p.prefixes(joined) for p in self.polynomials]
        known: dict[str, int] = {}
        code = np.array([known.setdefault(x, len(known)) for x in langs], np.int64)
        shift = np.array([self.of_lang(x) for x in known], np.uint64).reshape(-1, 3)

        def hashed(first: np.ndarray, k: int) -> list[np.ndarray]:
            own = shift[code[doc[first]]]
            return [(p.of(pre, place[first], place[first + k - 1] + sizes[first + k - 1]) + own[:, i]) % p.prime
                    for i, (p, pre) in enumerate(zip(self.polynomials, prefixes))]

        first = np.arange(max(0, len(begin) - n + 1))
        first = first[piece[first] == piece[first + n - 1]]
        if table is not None:
            inner = np.arange(max(0, len(begin) - n + 2))
            inner = inner[piece[inner] == piece[inner + n - 2]]
            one, two, _ = hashed(inner, n - 1)
            ok = np.zeros(len(begin) + 1, bool)
            ok[inner] = passes(table, one << np.uint64(31) | two)
            first = first[ok[first] & ok[first + 1]]
        one, two, check = hashed(first, n)
        at = doc[first]
        return at, begin[first] - starts[at], end[first + n - 1] - starts[at], one << np.uint64(31) | two, check


def bit_places(keys: np.ndarray) -> list[np.ndarray]:
    return [(keys * odd) >> np.uint64(64 - BITS) for odd in ODD[:PLACES]]


def passes(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    ok = np.ones(len(keys), bool)
    for at in bit_places(keys):
        ok &= (table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return ok


def bit_table(keys: DataFrame) -> np.ndarray:
    """The bits of ``keys(key)``: 8 MB at any size, put together by an aggregation of at most a row per 64 bits."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(bit_places(np.asarray(batch.column(0)).astype(np.uint64)))
            yield pa.RecordBatch.from_arrays([
                pa.array((at >> np.uint64(6)).astype(np.int32)),
                pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["slot", "bits"])

    found = keys.select("key").mapInArrow(places, "slot int, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << (BITS - 6), np.uint64)
    table[np.asarray(found["slot"])] = np.asarray(found["bits"]).view(np.uint64)
    return table


def prepared(docs: DataFrame) -> DataFrame:
    """``(at, lang, text)``: where pointers lead.  Rows without an id are named by their text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("at"),
                       F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text").where(F.length("text") > 0)


def text_blocks(texts: list[str]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """``(bytes, first bytes of its documents, their rows, how many bytes of the document stand before)``.

    About ``BLOCK`` bytes each.  A longer document is cut behind bytes that end a piece, so no n-gram is cut.
    """
    raw, starts, rows, before, size = [], [], [], [], 0

    def closed():
        return b"".join(raw), np.array(starts, np.int64), np.array(rows, np.int64), np.array(before, np.int64)

    for row, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass")
        cuts = [0, len(data)]
        if len(data) > BLOCK:
            stops = np.flatnonzero(np.isin(np.frombuffer(data, np.uint8), list(BREAKS))) + 1
            last = np.searchsorted(stops, np.arange(BLOCK, len(data), BLOCK))
            cuts = sorted({0, *stops[np.minimum(last, len(stops) - 1)].tolist(), len(data)}) if len(stops) else cuts
        for lo, hi in zip(cuts, cuts[1:]):
            if raw and size + hi - lo > BLOCK:
                yield closed()
                raw, starts, rows, before, size = [], [], [], [], 0
            raw.append(data[lo:hi])
            starts.append(size)
            rows.append(row)
            before.append(lo)
            size += hi - lo
    if raw:
        yield closed()


def occurrences(texts: DataFrame, n: int, table=None) -> DataFrame:
    """``(key, n, check, at, span)`` per key and block; span is ``first byte << 31 | bytes`` of one occurrence."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        bits = None if table is None else table.value
        for batch in batches:
            ids, langs = np.asarray(batch.column(0)), batch.column(1).to_pylist()
            for raw, starts, rows, before in text_blocks(batch.column(2).to_pylist()):
                doc, begin, end, key, check = hasher.grams(raw, starts, [langs[r] for r in rows], n, bits)
                if not len(key):
                    continue
                order = np.argsort(key, kind="stable")
                key = key[order]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                one = order[first]
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (
                    key[first], np.diff(np.append(first, len(key))), np.add.reduceat(check[order], first), ids[rows[doc[one]]],
                    begin[one] + before[doc[one]] << 31 | end[one] - begin[one])], ["key", "n", "check", "at", "span"])

    return texts.mapInArrow(counted, "key long, n long, check long, at long, span long")


def frequent_keys(texts: DataFrame, most: int, least: int) -> DataFrame:
    """``(key, f, check, at, span)`` of all n-grams up to ``most`` words that occur ``least`` times, by key."""
    spark = texts.sparkSession
    found, table = [], None
    for n in range(1, most + 1):
        level = materialize(
            occurrences(texts, n, table).groupBy("key").agg(
                F.sum("n").alias("f"), F.sum("check").alias("check"), F.min("at").alias("at"), F.min_by("span", "at").alias("span"))
            .where(F.col("f") >= least), f"frequent-{n}")
        found.append(level)
        if n < most:
            table = spark.sparkContext.broadcast(bit_table(level))  # of a fixed size
    return union_all(found)


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def written(raw: str) -> str:
    """SQL: the phrase of the bytes ``raw``, lower-cased and with single spaces."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"regexp_replace(translate(CAST({raw} AS STRING), '{upper}', '{lower}'), '[ \\t]+', ' ')"


def looked_up(keys: DataFrame, texts: DataFrame) -> DataFrame:
    """``(key, f, lang, phrase, sure)`` by the pointers; sure: all occurrences have the phrase's check value."""
    needed = texts.join(keys.select("at").distinct(), "at", "left_semi").withColumn(
        "_text", F.xxhash64("lang", "text")).dropDuplicates(["at", "_text"])
    phrases = keys.join(needed, "at").select(
        "key", "f", "check", "lang",
        F.expr(written("substring(CAST(text AS BINARY), CAST(span >> 31 AS INT) + 1, CAST(span & 2147483647 AS INT))")).alias("phrase"))

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            own = [hasher.phrase(lang, p) for lang, p in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            key, f, check = (np.asarray(batch.column(i)) for i in range(3))
            same = key == np.array([k for k, _ in own], np.int64)
            sure = same & (f * np.array([c for _, c in own], np.int64) == check)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 1, 3, 4)), pa.array(sure), pa.array(same)],
                                             ["key", "f", "lang", "phrase", "sure", "same"])

    return phrases.mapInArrow(verified, "key long, f long, lang string, phrase string, sure boolean, same boolean").where(
        "same").drop("same").dropDuplicates(["key"])


def recounted(texts: DataFrame, keys: DataFrame, most: int, least: int) -> DataFrame:
    """``(lang, phrase, f)`` of the n-grams with one of these keys, by text."""
    table = texts.sparkSession.sparkContext.broadcast(bit_table(keys))

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for raw, starts, rows, _ in text_blocks(batch.column(2).to_pylist()):
                for n in range(1, most + 1):
                    doc, begin, end, key, _ = hasher.grams(raw, starts, [langs[r] for r in rows], n, None)
                    hit = np.flatnonzero(passes(table.value, key))
                    at = starts[doc[hit]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key[hit].astype(np.int64)), pa.array([langs[r] for r in rows[doc[hit]]], pa.string()),
                        pa.array([raw[lo:hi] for lo, hi in zip((at + begin[hit]).tolist(), (at + end[hit]).tolist())], pa.binary())],
                        ["key", "lang", "raw"])

    hits = texts.mapInArrow(spelled, "key long, lang string, raw binary").join(keys.select("key"), "key", "left_semi")
    return hits.groupBy("lang", F.expr(written("raw")).alias("phrase")).agg(F.count(F.lit(1)).alias("f")).where(F.col("f") >= least)


def frequencies(docs: DataFrame, most: int = MOST_WORDS, least: int = LEAST) -> DataFrame:
    """``(lang, phrase, words, f)`` of every phrase of up to ``most`` words that occurs ``least`` times in its language.

    ``docs(doc_id, text, lang)``: null texts are empty, a null lang is ``und``; repeated rows and rows without an id count
    like any other.
    """
    texts = prepared(docs)
    keys = frequent_keys(texts, most, least)
    found = materialize(looked_up(keys, texts), "phrases")
    sure = found.where("sure").select("lang", "phrase", "f")
    shared = materialize(keys.select("key").join(found.where("sure").select("key"), "key", "left_anti"), "shared-keys")
    if not shared.isEmpty():
        sure = sure.unionByName(recounted(texts, shared, most, least))
    return sure.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("words"), "f")


def scored(phrases: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """``(lang, phrase, words, a, k, l, r, score)``: every phrase of two words or more at its lowest cut.

    a and l * r are exact up to 10**13 occurrences (decimals of 38 digits).
    """
    part = lambda lo, n: F.array_join(F.slice(F.col("_w"), lo, n), " ")
    cuts = phrases.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("_w"),
                                              F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "words", "a", "k", part(F.lit(1), F.col("k")).alias("_left"),
                       part(F.col("k") + 1, F.col("words") - F.col("k")).alias("_right"))
    for side, name in (("_left", "l"), ("_right", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    exact = lambda c: f"CAST({c} AS DECIMAL(13,0))"
    score = F.expr(f"CAST(1000000 AS DECIMAL(7,0)) * ({exact('a')} * {exact('a')}) div ({exact('l')} * {exact('r')})")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c")
    return cuts.groupBy("lang", "phrase").agg(F.first("words").alias("words"), F.first("a").alias("a"), best).select(
        "lang", "phrase", "words", "a", "c.k", "c.l", "c.r", "c.score")


def collocations(docs: DataFrame, most: int = MOST_WORDS, least: int = LEAST, absorbed: int = ABSORBED,
                 first: int = FIRST) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``first`` phrases of each language.

    A phrase goes when a longer one that holds it occurs at least ``absorbed`` percent as often.
    """
    phrases = materialize(frequencies(docs, most, least), "frequencies")
    word = F.split("phrase", " ")
    sizes = F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("_n")
    inner = (phrases.where("words >= 3").select("lang", "f", "words", word.alias("_w"), sizes)
             .select("lang", "f", "_w", "_n", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("_n") + 1)).alias("_lo"))
             .select("lang", F.array_join(F.slice("_w", F.col("_lo"), F.col("_n")), " ").alias("phrase"), "f")
             .groupBy("lang", "phrase").agg(F.max("f").alias("_longer")))
    kept = scored(phrases, most).join(inner, ["lang", "phrase"], "left").where(
        F.col("_longer").isNull() | (100 * F.col("_longer") < absorbed * F.col("a")))
    ranked = top_k(kept.select("lang", "phrase", "a", "l", "r", "score"), ["lang"],
                   [F.desc("score"), F.desc("a"), F.asc("phrase")], first, "rank")
    totals = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("n")) \
        .groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM lists, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size),
f AS (SELECT lang, size, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM f WHERE size >= 2),
scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, l.f AS l, r.f AS r, 1000000 * c.a * c.a // (l.f * r.f) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:c.size], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT lang, f, string_split(phrase, ' ') AS w, unnest([1, 2]) AS i FROM f WHERE size = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""
