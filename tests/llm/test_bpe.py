import hashlib
import random

import pytest
import tiktoken

from tastegraph.llm import bpe

ROOT = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(bpe.rank_file())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=bpe.pattern(), mergeable_ranks=ranks, special_tokens={})


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode_bytes(ids)).hexdigest())


def test_like_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    rows = bpe.op12_bpe(spark, ROOT).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows} == {
        i: digests(library, t) for i, t in texts.items()}


def test_odd_texts(ranks, library):
    own = bpe.Encoder(ranks, bpe.pattern())
    rng = random.Random(2)
    bits = ["a", "word", " ", "  ", "\n", "\t", "'s", "'ll", "don't", "é", "😀", "日本語", "12", "٣", "!?", "<|endoftext|>", "　", "\x00",
            "\x1c", "\x85", "_", "½", "́", "ﷺ", "aaaaaaaaaaaa", "ababababab", "🇩🇪", "�"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 12))) for _ in range(3000)]
    texts += ["x" * 50_000, "日本" * 20_000, "".join(rng.choices("abcdefgh", k=30_000)), " " * 5000, "=" * 3000]
    for text, got in zip(texts, own(texts)):
        assert got == b"".join(i.to_bytes(4, "little") for i in library.encode_ordinary(text)), text[:80]


def test_every_code_point(ranks, library):
    own = bpe.Encoder(ranks, bpe.pattern())
    texts = ["".join(f"ab {chr(c)}a 1{chr(c)}  {chr(c)}{chr(c)}\n" for c in range(lo, lo + 256) if not 0xD800 <= c < 0xE000)
             for lo in range(0, 0x110000, 256)]
    for text, got in zip(texts, own(texts)):
        assert got == b"".join(i.to_bytes(4, "little") for i in library.encode_ordinary(text)), hex(ord(text[3]) if text else 0)


def test_perfect_hash(ranks):
    table = bpe.PerfectHash(list(ranks))
    slots = table.slots(list(ranks))
    assert sorted(slots.tolist()) == list(range(len(ranks)))
    assert (table.slots([b"no such token", b"", b"\xff\xff\xff"]) == -1).all()
    assert all(bpe.PerfectHash(keys).slots(keys).tolist() != [-1] for keys in ([b"a"], [b"a", b"b"], [b"a", b"b", b"c"]))
    assert bpe.PerfectHash([]).slots([b"a"]).tolist() == [-1]
    with pytest.raises(ValueError):
        bpe.PerfectHash([b"a", b"a"])


def test_merge_by_scanning(ranks):
    """The heap against the plain rule: the leftmost pair of lowest rank, again and again."""
    rng = random.Random(4)
    for _ in range(300):
        piece = bytes(rng.choices(b"abeinrst \xc3\xa9", k=rng.randint(1, 40)))
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while pairs := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]:
            i = min(pairs)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        assert bpe.merge(piece, ranks) == [ranks[p] for p in parts]


def test_odd_rows(spark, odd, empty, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 50)  # texts longer than a block, several blocks in a batch
    rows = bpe.decode(bpe.encode(odd)).collect()
    assert len(rows) == odd.count()
    want = sorted((str(r["doc_id"]), library.encode_ordinary(r["text"] or ""), (r["text"] or "").encode()) for r in odd.collect())
    assert sorted((str(r["doc_id"]), r["ids"], bytes(r["decoded"])) for r in rows) == want
    assert bpe.decode(bpe.encode(empty)).count() == 0
    none = spark.createDataFrame([(1, None), (2, []), (3, [1])], "doc_id long, ids array<int>")
    assert [bytes(r["decoded"]) for r in bpe.decode(none).orderBy("doc_id").collect()] == [b"", b"", library.decode_bytes([1])]
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [50_256])], "doc_id long, ids array<int>")).collect()
