import random
import re

from tastegraph.llm import urlfilter


def verdicts(spark, urls, **kw):
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)],
                               "page_id long, url string, rule string, host string")
    return [tuple(r)[1:] for r in urlfilter.judge(df, **kw).orderBy("page_id").collect()]


def test_rules(spark):
    urls = ["http://Www.Example.COM/en/a?x=/fr/", "https://example.com/en/", "https://notexample.com/en/x",
            "http://a.b.net/es/", "net/es/", "ftp://net/fr/x#y", "http://example.com", "x://y.org/a.net/es/",
            "a://b.com/c://d.net/es/", "http://com?/x", None, "", "http://É.COM/é"]
    assert verdicts(spark, urls) == [
        ("www.example.com", "/en/a", "www.example.com/en/", "allow"), ("example.com", "/en/", "example.com/en/", "block"),
        ("notexample.com", "/en/x", "com/", "allow"), ("a.b.net", "/es/", "net/es/", "block"), ("", "", None, "allow"),
        ("net", "/fr/x", "net/fr/", "block"), ("example.com", "", None, "allow"), ("y.org", "/a.net/es/", None, "allow"),
        ("b.com", "/c://d.net/es/", "com/", "allow"), ("com", "", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("É.com", "/é", "com/", "allow")]


def test_many_rules_like_one_by_one(spark):
    """Rules over many words of state, against the definition."""
    rng = random.Random(7)
    part = lambda: "".join(rng.choices("ab", k=rng.randint(1, 3)))
    texts = {".".join(part() for _ in range(rng.randint(1, 3))) + "/" + "".join(part() + "/" for _ in range(rng.randint(0, 2)))
             for _ in range(150)}
    rules = [(rng.choice(["allow", "block"]), t) for t in sorted(texts)]
    urls = ["h://" + ".".join(part() for _ in range(rng.randint(1, 4))) + "/" * rng.randint(0, 1)
            + "/".join(part() for _ in range(rng.randint(0, 4))) for _ in range(500)]
    for url, (host, path, rule, verdict) in zip(urls, verdicts(spark, urls, rules=rules, default="block")):
        best = None
        for v, t in rules:
            h, p = t.split("/", 1)
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (not best or len(t) > len(best[1])):
                best = v, t
        if best:
            assert len(rule) == len(best[1]) and (verdict, rule) in rules
        else:
            assert (rule, verdict) == (None, "block")


def test_globs_like_patterns():
    rng = random.Random(8)
    globs = ["".join(rng.choices(["a", "b", "?", "*", "**", "/"], k=rng.randint(0, 6))) for _ in range(120)]
    texts = ["".join(rng.choices("ab/", k=rng.randint(0, 8))).encode() for _ in range(300)]
    hits = urlfilter.run(urlfilter.compile_globs(globs), texts)
    for g, column in zip(globs, hits.T):
        pattern = re.sub(r"(\*\*+)|(\*)|(\?)", lambda m: ".*" if m[1] else "[^/]*" if m[2] else ".", re.sub(r"\*\*+", "**", g))
        assert [bool(re.fullmatch(pattern, t.decode())) for t in texts] == list(column), g
    assert urlfilter.run(urlfilter.compile_globs(["a"]), []).shape == (0, 1)


def test_empty_table(spark):
    assert verdicts(spark, []) == []


def test_long_and_repeated_urls(spark):
    """Rules are seen at the end of a very long host and before a very long path; repeated rows stay rows."""
    host, path = "a." * 50_000 + "net", "/es/" + "x" * 500_000
    long, other = f"http://{host}{path}", f"http://{host}.org{path}"
    assert verdicts(spark, [long, other, long]) == [
        (host, path, "net/es/", "block"), (f"{host}.org", path, None, "allow"), (host, path, "net/es/", "block")]
