import math
import random
import struct
import zlib
from collections import defaultdict

from tokenizers import Tokenizer

from tastegraph.llm import packing

ROOT = "/root/testdata/sf0.01"


def check(rows, texts):
    """Whole documents, right digests, sequences without gaps."""
    own = Tokenizer.from_file(packing.vocabulary())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r["piece"])):
            raw = struct.pack(f"<{r['length']}I", *ids[at:at + r["length"]])
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(raw))
            assert r["length"] == 1024 or k == 0
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    return len(sequences), sum(r["length"] for r in rows)


def test_round_trip(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    n, tokens = check(packing.op7_pack(spark, ROOT).collect(), texts)
    assert n <= 1.01 * math.ceil(tokens / 1024)


def test_words_apart_give_the_ids_of_the_whole():
    own = Tokenizer.from_file(packing.vocabulary())
    rng = random.Random(3)
    bits = ["a", "word", " ", "  ", "\n", " \n", "\t", "'s", "don't", "é", "😀", "日本", "12", "!?", ".", "<|endoftext|>",
            "　", " ", "\x00", "_", "½"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 12))) for _ in range(3000)]
    encode = packing.encoder(packing.vocabulary())
    for text, got in zip(texts, encode(texts)):
        ids = own.encode(text, add_special_tokens=False).ids
        assert got == struct.pack(f"<{len(ids)}I", *ids), repr(text)


def test_two_for_one():
    # greedy takes 6 and 3, gap 1; the 3 gives way to 2 + 2
    assert packing.plan({6: 1, 3: 1, 2: 2}, 10) == [(1, [6, 2, 2]), (1, [3])]
    # with one 2 only, nothing fits better
    assert packing.plan({6: 1, 3: 1, 2: 1}, 10) == [(1, [6, 3]), (1, [2])]


def test_plan_uses_everything_once():
    rng = random.Random(4)
    for _ in range(50):
        counts = {rng.randint(1, 99): rng.randint(1, 1000) for _ in range(rng.randint(0, 60))}
        left = dict(counts)
        for times, fill in packing.plan(counts, 100):
            assert times > 0 and sum(fill) <= 100
            for n in fill:
                left[n] -= times
        assert not any(left.values())


def test_odd_rows(odd, empty):
    rows = packing.pack(packing.cut(odd)).collect()
    once = {r["doc_id"]: r["text"] for r in odd.collect()}
    assert sum(r["piece"] == 0 for r in rows) == odd.count()  # the repeated row is packed twice
    seen, single = set(), []
    for r in rows:
        if (r["doc_id"], r["piece"]) not in seen:
            seen.add((r["doc_id"], r["piece"]))
            single.append(r)
    assert {r["doc_id"] for r in single} == set(once)
    by_sequence = defaultdict(int)
    for r in rows:
        by_sequence[r["sequence_id"]] += r["length"]
    assert max(by_sequence.values()) <= 1024
    assert packing.pack(packing.cut(empty)).count() == 0
