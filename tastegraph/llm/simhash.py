"""SimHash fingerprints of 64 bits, and those of them within a Hamming radius, as pairs or counted.

Terms are runs of three words.  Every occurrence of a term votes on each bit with the
bit of its hash; a bit is set when more than half of the votes are for it.  Two counters of 32 bits share
one long, so 32 plain sums count all 64 bits and partial sums leave each task as one row
per text.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import numbered
from ..session import materialize
from .common import read

BITS = 64
TERM_WORDS = 3
LANES = 0x0000000100000001
#: Bits by which fingerprints may differ to be near, and blocks that a table asks of them beyond those needed.
RADIUS, SPARE = 3, 2
#: Fingerprints of a list that is compared with another list inside one row (expected).
LIST = 1024


def votes(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``(keys, fingerprint)`` as a long; rows that agree on ``keys`` vote together.

    Words are as in the other operators.  The last two words open terms too, of two and one
    words, so a text of one word has a term.  A text without words has no votes: 0.
    """
    words = F.split(F.col(text), r"[\x20\x09-\x0D]+")
    opened = texts.select(*keys, F.filter(words, lambda w: w != "").alias("_w"))
    shifted = [F.col("_w"), *[F.slice(F.col("_w"), i + 1, F.greatest(F.size("_w"), F.lit(1)))
                              for i in range(1, TERM_WORDS)]]
    terms = opened.select(*keys, F.explode_outer(F.arrays_zip(
        *[c.alias(f"w{i}") for i, c in enumerate(shifted)])).alias("_t"))
    term = F.when(F.col("_t").isNotNull(), F.xxhash64(*[F.col(f"_t.w{i}") for i in range(TERM_WORDS)]))
    counted = terms.select(*keys, term.alias("_h")).groupBy(*keys).agg(
        F.count("_h").alias("_n"),
        *[F.sum(F.shiftright("_h", i).bitwiseAND(F.lit(LANES))).alias(f"_l{i}") for i in range(32)])
    bits = F.lit(0).cast("long")
    for i in range(32):
        for shift, lane in ((i, F.col(f"_l{i}").bitwiseAND(F.lit(0xFFFFFFFF))),
                            (i + 32, F.shiftrightunsigned(f"_l{i}", 32))):
            one = (1 << shift) - (1 << 64 if shift == 63 else 0)
            bits = bits + F.when(lane * 2 > F.col("_n"), F.lit(one).cast("long")).otherwise(F.lit(0).cast("long"))
    return counted.select(*keys, bits.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_text(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), BITS // 4, "0"))


def within(prints: DataFrame, radius: int, spare: int = 2) -> DataFrame:
    """``(a, b, distance)``, a < b: all pairs of different fingerprints at most ``radius`` bits apart.

    ``prints`` has a column ``fingerprint`` (long); equal ones, nulls apart, are one class.  The
    bits are cut into ``radius + spare`` blocks.  Two prints within the radius agree on at least
    ``spare`` blocks, so a table per choice of that many blocks, keyed by their bits, brings every such
    pair together.  A pair is kept by the first table that holds it.
    """
    blocks = radius + spare
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    chosen = list(itertools.combinations(range(blocks), spare))

    def mask(picked: tuple[int, ...]) -> int:
        m = sum(((1 << edges[i + 1]) - (1 << edges[i])) for i in picked)
        return m - (1 << 64) if m >> 63 else m

    masks = F.array(*[F.lit(mask(c)).cast("long") for c in chosen])
    distinct = materialize(prints.select("fingerprint").where(F.col("fingerprint").isNotNull()).distinct(), "prints")
    keyed = distinct.select("fingerprint", F.posexplode(masks).alias("_table", "_mask")).select(
        "fingerprint", "_table", F.col("fingerprint").bitwiseAND(F.col("_mask")).alias("_key"))
    left, right = keyed.withColumnRenamed("fingerprint", "a"), keyed.withColumnRenamed("fingerprint", "b")
    apart = F.col("a").bitwiseXOR(F.col("b"))
    first = F.array_position(F.transform(masks, lambda m: apart.bitwiseAND(m) == 0), True) - 1
    return (left.join(right, ["_table", "_key"])
            .where((F.col("a") < F.col("b")) & (F.bit_count(apart) <= radius) & (first == F.col("_table")))
            .select("a", "b", F.bit_count(apart).alias("distance")))


def near_counts(prints: DataFrame, radius: int = RADIUS, spare: int = SPARE, size: int = LIST) -> DataFrame:
    """``(fingerprint, near)``: how many other fingerprints lie within the radius, for those that have any.

    The tables are those of :func:`within`, but no pair becomes a row: a bucket is cut into lists of about
    ``size`` fingerprints, lists of a bucket meet, and each member of one counts those near it in the other.
    A bucket of n fingerprints so gives n * n / size / size meetings and at most n * n / size counts.  A pair counts in
    its first table only: the one of the first blocks on which it agrees, so it differs in all blocks before the
    last of the table that are not the table's own.
    """
    blocks = radius + spare
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    chosen = list(itertools.combinations(range(blocks), spare))

    def mask(picked: Iterable[int]) -> Column:
        m = sum((1 << edges[i + 1]) - (1 << edges[i]) for i in picked)
        return F.lit(m - (1 << 64) if m >> 63 else m).cast("long")

    masks = F.array(*[mask(c) for c in chosen])
    others = F.array(*[F.array(*[mask([i]) for i in range(c[-1]) if i not in c]).cast("array<long>") for c in chosen])
    bucket = ["_table", "_key"]
    distinct = materialize(prints.select("fingerprint").where(F.col("fingerprint").isNotNull()).distinct(), "prints")
    keyed = distinct.select("fingerprint", F.posexplode(masks).alias("_table", "_mask")).select(
        "fingerprint", "_table", F.col("fingerprint").bitwiseAND(F.col("_mask")).alias("_key"))
    shared = keyed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    part = F.pmod(F.xxhash64("fingerprint", F.lit(5)), F.ceil(F.col("_n") / size))
    lists = materialize(keyed.join(shared, bucket).groupBy(*bucket, part.alias("_part")).agg(
        F.collect_list("fingerprint").alias("_own")), "print-lists")
    met = lists.select(*bucket, "_own").join(lists.select(*bucket, F.col("_own").alias("_met")), bucket).withColumn(
        "_differ", F.element_at(others, F.col("_table") + 1))

    def near(a: Column, b: Column) -> Column:
        apart = a.bitwiseXOR(b)
        return (F.bit_count(apart) <= radius) & (apart != 0) & F.forall(
            "_differ", lambda m: apart.bitwiseAND(m) != 0)

    counts = F.transform("_own", lambda a: F.struct(a.alias("fingerprint"), F.size(
        F.filter("_met", lambda b: near(a, b))).alias("n")))
    return (met.select(F.explode(F.filter(counts, lambda c: c["n"] > 0)).alias("c")).groupBy("c.fingerprint")
            .agg(F.sum("c.n").alias("near")))


def edited_prints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited form (see ``op5_simhash``).

    ``near_prints`` counts the other fingerprints of texts within ``RADIUS`` bits of the text's own.

    The next document is the one with the next larger doc_id; the first follows the last.
    Rows without an id are left out.  Of rows that share an id, each keeps its own
    result, and the one with the least hash of its text stands for it as a next document.
    The text crosses the network once, keyed by id; heads of next documents, at most a quarter of it, follow.
    """
    docs = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    own = docs.select("id", "text", F.xxhash64("text").alias("th"))
    ids = materialize(docs.groupBy("id").agg(F.max(F.floor(F.length("text") / 4)).cast("int").alias("need")), "next-ids")
    ranked = materialize(numbered(ids, [], ["id"], "next-order"), "next-rank")
    n = ranked.count()
    follows = ranked.select((F.pmod(F.col("rank"), F.lit(max(n, 1))) + 1).alias("rank"),
                            F.col("id").alias("prev"), "need")
    follows = materialize(ranked.select("id", "rank").join(follows, "rank").select("id", "prev", "need"), "next")
    heads = own.join(follows, "id").select(
        "prev", F.struct("th", F.substring("text", F.lit(1), F.col("need")).alias("head")).alias("h")).groupBy(
        F.col("prev").alias("id")).agg(F.min("h").getField("head").alias("head"))
    chars = F.length("text")
    cut = F.floor(chars / 4).cast("int")
    both = own.join(heads, "id").select(
        "id", "th", "text", chars.cast("long").alias("n_chars"), F.concat(
            F.substring("text", F.lit(1), chars - cut), F.substring("head", F.lit(1), cut)).alias("edited"))
    sides = both.select("id", "th", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("t")),
        F.struct(F.lit(1).alias("side"), F.col("edited").alias("t")))).alias("s"))
    prints = votes(sides.select("id", "th", "s.side", "s.t"), ["id", "th", "side"], "t").groupBy("id", "th").agg(
        F.max(F.when(F.col("side") == 0, F.col("fingerprint"))).alias("p"),
        F.max(F.when(F.col("side") == 1, F.col("fingerprint"))).alias("e"))
    done = materialize(both.select("id", "th", "n_chars", F.sha2("edited", 256).alias("edited_sha256")).join(
        prints, ["id", "th"]), "prints-edited")
    following = done.groupBy("id").agg(F.min(F.struct("th", "p")).getField("p").alias("next")).join(
        follows.select("id", "prev"), "id").select(F.col("prev").alias("id"), "next")
    close = near_counts(done.select(F.col("p").alias("fingerprint"))).withColumnRenamed("fingerprint", "p")
    return done.join(following, "id").join(close, "p", "left").select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", as_text(F.col("p")).alias("fingerprint"),
        as_text(F.col("e")).alias("edited_fingerprint"), likeness(F.col("p"), F.col("e")).alias("near_edited"),
        likeness(F.col("p"), F.col("next")).alias("near_next"), F.coalesce("near", F.lit(0)).alias("near_prints"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text and its edited form: the last quarter of its code points (rounded down) gives way to
    as many from the start of the next document, or to all of that if it is shorter."""
    return edited_prints(read(spark, sf_dir, "documents", "doc_id", "text"))
