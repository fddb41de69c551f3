import hashlib
import itertools
import random
import re

import xxhash

from tastegraph.llm import simhash

ROOT = "/root/testdata/sf0.001"


def print_of(text):
    """The fingerprint by counting."""
    words = [w.encode() for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    votes = [0] * 64
    for i in range(len(words)):
        h = 42
        for w in words[i:i + 3]:
            h = xxhash.xxh64_intdigest(w, h)
        for b in range(64):
            votes[b] += 1 if h >> b & 1 else -1
    return sum(1 << b for b in range(64) if votes[b] > 0)


def expected(rows):
    ids = sorted(rows)
    prints = {print_of(t or "") for t in rows.values()}
    out = {}
    for i, after in zip(ids, [*ids[1:], ids[0]]):
        t, n = rows[i] or "", len(rows[i] or "") // 4
        edited = t[:len(t) - n] + (rows[after] or "")[:n]
        p, e, q = print_of(t), print_of(edited), print_of(rows[after] or "")
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{p:016x}", f"{e:016x}",
                  1 - (p ^ e).bit_count() / 64, 1 - (p ^ q).bit_count() / 64,
                  sum((p ^ o).bit_count() <= simhash.RADIUS for o in prints) - 1)
    return out


def found(df):
    return {r["doc_id"]: tuple(r)[1:] for r in df.collect()}


def test_like_counting(spark):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    assert found(simhash.op5_simhash(spark, ROOT)) == expected(rows)


def test_odd_rows(odd, empty):
    rows = {r["doc_id"]: r["text"] for r in odd.collect() if r["doc_id"] is not None}
    df = simhash.edited_prints(odd)
    assert df.count() == 12 - 1  # the row without an id
    assert found(df) == expected(rows)
    assert simhash.edited_prints(empty).count() == 0


def test_one_document_follows_itself(spark):
    df = simhash.edited_prints(spark.createDataFrame([(7, "a b c d e f")], "doc_id long, text string"))
    assert df.first()["near_next"] == 1


def test_all_pairs_within_the_radius(spark):
    rng = random.Random(2)
    prints = [rng.getrandbits(64) for _ in range(40)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for p in prints for _ in range(5)]
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    df = spark.createDataFrame([(p,) for p in [*signed, signed[0], None]], "fingerprint long")
    for radius in (0, 3, 7):
        near = {(a, b, ((a ^ b) & (2**64 - 1)).bit_count()) for a, b in itertools.combinations(signed, 2)
                if ((a ^ b) & (2**64 - 1)).bit_count() <= radius}
        got = [tuple(r) for r in simhash.within(df, radius).collect()]
        assert len(got) == len(set(got)) and set(got) == near


def test_counts_within_the_radius(spark):
    """One ball of near fingerprints in many lists, and some far ones; equal and null rows change nothing."""
    rng = random.Random(3)
    base = rng.getrandbits(64)
    prints = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(150)}
    prints |= {rng.getrandbits(64) for _ in range(50)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    df = spark.createDataFrame([(p, "x") for p in [*signed, *signed[:20], None]], "fingerprint long, near string")
    for radius, size in ((0, 1024), (2, 7), (3, 1024), (5, 30)):
        near = {a: n for a in signed if (n := sum(
            ((a ^ b) & (2**64 - 1)).bit_count() <= radius for b in signed) - 1)}
        assert {r[0]: r[1] for r in simhash.near_counts(df, radius, size=size).collect()} == near
