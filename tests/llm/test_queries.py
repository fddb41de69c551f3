import duckdb
import pytest

import __spark_entry__ as entry
from tastegraph.llm import queries

ROOT = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    df = queries.QUERIES[name](spark, ROOT)
    columns = sorted(df.columns)
    mine = sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    result = con.sql(queries.ORACLES[name])
    assert sorted(result.columns) == columns
    assert mine and mine == sorted(result.select(*[f'"{c}"' for c in columns]).fetchall(), key=str)


def test_one_query_per_operator():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names


def test_pipeline(spark, odd, empty):
    """Columns and falling counts stage by stage, and odd and empty tables."""
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    kept = docs
    sizes = [docs.count()]
    for _, stage in p.STAGES[:4]:
        kept = stage(spark, kept, ROOT)
        assert kept.columns == docs.columns
        sizes.append(kept.count())
    assert sizes[0] >= sizes[1] > sizes[2] > sizes[3]
    for start in (odd, empty):
        for _, stage in p.STAGES[:4]:
            assert stage(spark, start, ROOT).columns == start.columns
            stage(spark, start, ROOT).count()
        p.STAGES[4][1](spark, start, ROOT).count()


def test_near_duplicate_stage_by_its_rule(spark, odd):
    """One row of each group that all pairs give, rows without an id and rows that share one included."""
    import corpus_pipeline as p
    from test_pathjoin import brute

    docs = odd.unionByName(odd.selectExpr("1 AS doc_id", "'another text under an id that is taken' AS text", *odd.columns[2:]).limit(1))
    rows = list(enumerate(r["text"] for r in docs.collect()))
    groups = {}
    for i, (_, group) in brute(rows, 5, 80).items():
        groups.setdefault(group, set()).add(rows[i][1])
    kept = [r["text"] for r in p.deduplicated(spark, docs, ROOT).collect()]
    assert len(kept) == len(groups) and all(sum(t in texts for t in set(kept)) >= 1 for texts in groups.values())
    assert "another text under an id that is taken" in kept


def test_run_gives_whole_sequences(spark):
    """The whole of run(): gapless sequences of pieces of documents that the first stages keep."""
    import corpus_pipeline as p

    root = "/root/testdata/sf0.001"
    at, known = {}, {r["doc_id"] for r in spark.read.parquet(f"{root}/documents.parquet").select("doc_id").collect()}
    for r in sorted(p.run(spark, root).collect(), key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0) and r["doc_id"] in known
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert at and max(at.values()) <= 1024
