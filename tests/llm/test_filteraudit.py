import itertools
import random
import re
from collections import Counter

from tastegraph.llm import filteraudit


def brute(rows, labels):
    """Every document through every order."""
    first, found = {}, []
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, text, lang in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": re.search(r"[#$%&*|]", text),
                 "E": i is not None and i > first[text]}
        found.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = {}
    for part in {p for p, *_ in found}:
        docs = [d[1:] for d in found if d[0] == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            here, name = docs, "".join(order)
            for step, f in enumerate(order, 1):
                gone = [d for d in here if f in d[0]]
                here = [d for d in here if f not in d[0]]
                shapley[f] += len(gone)
                out[part, name, step] = [len(here), len(gone), sum(f in d[0] for d in docs) - len(gone),
                                         sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, name, step), v in out.items():
            if p == part:
                v.append(shapley[name[step - 1]])
    return out


def got(df):
    rows = df.collect()
    found = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in rows}
    assert len(found) == len(rows)
    return found


def test_every_order_like_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        words = rng.choices([f"w{k}" for k in range(rng.choice([20, 4000]))], k=rng.choice([3, 99, 100, 300]))
        text = " ".join(w.upper() if rng.random() < 0.2 and i % 3 else w for w in words) + rng.choice(["", "", " 5%"])
        rows.append((i, rng.choice([text, text, None, "", "same text"]), rng.choice(["en", "fr", None, ""])))
    rows += rows[:20]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 400, 2)] + [(4, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS mask", "2 AS part")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert got(filteraudit.audit(filteraudit.tally(docs, known))) == brute(rows, labels)


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd.collect()]
    assert got(filteraudit.audit(filteraudit.tally(odd, labels))) == brute(rows, [(1, 1, None)])
    assert filteraudit.audit(filteraudit.tally(empty, labels)).count() == 0
    assert len(got(filteraudit.audit(filteraudit.tally(odd, labels.limit(0))))) == 600 * 3


def test_intervals_cover_each_order_once():
    for n in (1, 3, 5):
        orders = list(itertools.permutations(range(n)))
        seen = Counter()
        for mask, step, begin, end in filteraudit.intervals(n):
            for rank in range(begin, end):
                order = orders[rank]
                assert mask >> order[step - 1] & 1 and not any(mask >> k & 1 for k in order[:step - 1])
                seen[mask, rank] += 1
        assert len(seen) == (2**n - 1) * len(orders) and set(seen.values()) == {1}
