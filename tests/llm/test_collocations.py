import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tastegraph.llm import collocations

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, most=3, least=10, absorbed=50, first=2000):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for n in range(1, most + 1):
                counts[lang or "und"].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = set()
    for lang, f in counts.items():
        kept = []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            score, _, l, r = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= absorbed * a for b in longer):
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:first], 1):
            out.add((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return out


def got(df):
    rows = [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = ["the", "The", "old", "man", "é", "日本", "and", "x", "Ünder", "a.b", "no-one", "#"] + [f"w{i}" for i in range(30)]
    out = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 120)):
            parts += rng.choice([["New", "York", "city"], ["New", "York"], [rng.choice(words)], [rng.choice(words)], ["x", "x", "x"]])
            parts[-1] += rng.choice(["", "", "", ",", ". ", "\n", "!?"])
        out.append((rng.choice([i, i, None, 7]), rng.choice(["", " ", "\t"]) + rng.choice([" ", "  ", "\t "]).join(parts), rng.choice(["en", "fr", None])))
    return out + out[:10] + [(200, None, "en"), (201, "", "fr"), (202, ".,;", "de")]


@pytest.mark.parametrize("options", [{}, {"most": 4, "least": 5, "absorbed": 80, "first": 30}])
def test_like_brute_force(spark, rows, options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS key", "2 AS at", "3 AS f")
    want = brute(rows, **options)
    assert want and got(collocations.collocations(docs, **options)) == want


def test_shared_fingerprints_are_counted_by_text(spark, rows, monkeypatch):
    """Keys of a few bits: many phrases share one."""
    monkeypatch.setattr(collocations, "PRIMES", (31, 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert got(collocations.collocations(docs)) == brute(rows)


def test_small_blocks_and_full_bit_table(spark, rows, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 64)
    monkeypatch.setattr(collocations, "BITS", 7)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert got(collocations.collocations(docs)) == brute(rows)


def test_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd.collect()]
    want = brute(rows, least=2)
    assert any(w[2] == "mot mot mot" and w[3] == 59_998 for w in want)
    assert got(collocations.collocations(odd, least=2)) == want
    assert collocations.collocations(empty).count() == 0


def test_fingerprints():
    h = collocations.Hasher()
    text = "Ab  cd\te. Ab cd"
    doc, begin, end, key, check = h.grams(text.encode(), np.array([0]), ["en"], 2, None)
    assert [text[b:e] for b, e in zip(begin, end)] == ["Ab  cd", "cd\te", "Ab cd"]
    assert key[0] == key[2] and check[0] == check[2] and key[0] != key[1]
    assert (int(key[0]), int(check[0])) == h.phrase("en", "ab cd") != h.phrase("fr", "ab cd")
    long = np.arange(1 << 23, dtype=np.int64).astype(np.uint8)
    p = collocations.Polynomial(collocations.PRIMES[0])
    assert int(p.of(p.prefixes(long), np.array([5]), np.array([9]))[0]) == sum(
        (b + 1) * pow(collocations.BASE, i, int(p.prime)) for i, b in enumerate(range(5, 9))) % int(p.prime)
