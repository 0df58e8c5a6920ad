"""The pipeline's stages and the registered queries."""

import re

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tallyworks.llm import simhash
from tallyworks.llm.queries import ORACLE_SQL, QUERIES
from tallyworks.session import keep_table
from tests.conftest import DATA_DIR, plan
from tests.oracle import connect, differences

NATIVE = ("op7_spotsigs", "op8_decontaminate")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_cover_the_documents(spark, name):
    found = QUERIES[name](spark, DATA_DIR)
    rows = found.collect()
    text = plan(found)
    assert "Cartesian" not in text and "NestedLoop" not in text
    if name in NATIVE:
        assert not re.search("Python|Arrow|Pandas", text)
    if name == "op12_top_k":
        assert sorted((row.query_id, row.rank) for row in rows) == [
            (query, rank) for query in range(0, 500, 20) for rank in range(1, 21)
        ]
    elif name != "op8_decontaminate":
        assert sorted(row.doc_id for row in rows) == list(range(200))


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA_DIR}/documents.parquet")
    before = None
    for _, stage in corpus_pipeline.STAGES:
        kept = keep_table(stage(spark, docs, DATA_DIR))
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert kept.columns == docs.columns
        assert before is None or kept.count() <= before
        before, docs = kept.count(), kept
    assert corpus_pipeline.run(spark, DATA_DIR).count() == before


def plain_groups(prints, max_bits):
    """Rows by the smallest row that links of few differing bits reach."""
    group = list(range(len(prints)))
    for _ in prints:
        for a, one in enumerate(prints):
            for b, other in enumerate(prints):
                if (one ^ other).bit_count() <= max_bits:
                    group[a] = group[b] = min(group[a], group[b])
    return group


def test_one_row_stays_of_each_group(spark, tmp_path):
    text = "the quick brown fox jumps over the lazy dog near the river bank"
    rows = [
        (7, text), (7, text), (3, text), (None, text),
        (None, "a text of its own that has no id at all"), (None, "and one more without an id"),
        (None, "a text of its own that has no id at all"),
        (9, "one id with a first text"), (9, "the same id and quite another text"),
        (9, "one id with a first text"), (1, "the same id and quite another text"),
    ]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, DATA_DIR).collect()
    groups = plain_groups([simhash.fingerprint(text.encode(), 3) & (1 << 64) - 1 for _, text in rows], 2)
    best = {}
    for at, (key, _) in enumerate(rows):
        rank = (key is None, key or 0, at)
        best[groups[at]] = min(best.get(groups[at], rank), rank)
    expected = [rows[at] for _, _, at in best.values()]
    assert sorted(map(tuple, kept), key=repr) == sorted(expected, key=repr)
    assert len(kept) == 5


def test_run_keeps_the_odd_rows_that_plain_python_keeps(spark, odd, tmp_path):
    path = str(tmp_path)
    docs = odd.select("doc_id", "text", "lang", "id").toDF("doc_id", "text", "lang", "source")
    docs = docs.selectExpr("*", "cast(length(text) AS bigint) AS n_chars")
    docs.unionByName(docs).coalesce(1).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "no such question is anywhere in here")], "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet"
    )
    docs = spark.read.parquet(f"{path}/documents.parquet")
    rows = [tuple(row) for row in corpus_pipeline.identify_language(spark, docs, path).collect()]
    prints = [simhash.fingerprint((row[1] or "").encode(), 3) & (1 << 64) - 1 for row in rows]
    best = {}
    for at, (row, group) in enumerate(zip(rows, plain_groups(prints, 2))):
        rank = (row[0] is None, row[0] or 0, at)
        best[group] = min(best.get(group, rank), rank)
    expected = [rows[at][0] for _, _, at in best.values()]
    found = [row.doc_id for row in corpus_pipeline.run(spark, path).collect()]
    assert None in expected and sorted(found, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_sql(spark, name):
    mine = QUERIES[name](spark, DATA_DIR).toArrow()
    assert differences(mine, connect(DATA_DIR).sql(ORACLE_SQL[name]).to_arrow_table()) == []


def test_columns_named_like_the_stages_own_pass_through(spark, tmp_path):
    rows = [(1, "the quick brown fox jumps over the lazy dog", "A", "B"), (2, "another text of its own", "C", None)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id bigint, text string, row string, Row_ string").write.parquet(path)
    docs = spark.read.parquet(path)
    for stage in (corpus_pipeline.drop_near_duplicates, corpus_pipeline.drop_contaminated):
        assert sorted(map(tuple, stage(spark, docs, DATA_DIR).collect())) == rows
    for _, stage in corpus_pipeline.STAGES[1:3]:
        assert stage(spark, docs.where("false"), DATA_DIR).count() == 0


def test_contract():
    names = contract.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert set(ORACLE_SQL) <= set(names)
    assert [f"op{n}_" for n in range(1, 14)] == sorted(
        {re.match(r"op\d+_", n)[0] for n in QUERIES}, key=lambda n: int(n[2:-1])
    )
