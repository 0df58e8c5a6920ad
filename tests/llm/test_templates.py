"""Decontamination: number-heavy items with other figures, and items of a word or two."""

import pytest

from tallyworks.llm import decontaminate

ITEMS = [
    (1, "What is 12 + 30 * 4 - 6 / 2 and then 7 plus 8 minus 9"),
    (2, "Compute 12 + 30 * 4 - 6 / 2 now"),
    (3, "Photosynthesis"),
    (4, "Who knows?"),
    (5, "A train travels 60 km in 2 hours, then 90 km in 3 hours; how far does it travel in 5 hours?"),
    (6, "1 2 3 4 5 6 7 8 9 10"),
    (7, ""),
]


@pytest.fixture(scope="module")
def found(spark, tmp_path_factory):
    docs = [
        (10, "So: what is 55 + 31 * 7 - 2 / 9 and then 4 plus 6 minus 1 ?"),
        (11, "Please compute 9 + 8 * 7 - 6 / 5 now, and thank you"),
        (12, "photosynthesis!"),
        (13, "Photosynthesis is what plants do; who knows more about it"),
        (14, "who knows"),
        (15, "A train travels 70 km in 4 hours, then 80 km in 6 hours; how far does it travel in 9 hours?"),
        (16, "4 8 15 16 23 42 99 100 7 12 and a table of figures 5 6 7 8 9 10 11 12"),
        (17, "counted: 1 2 3 4 5 6 7 8 9 10, and no more"),
        (18, "The 3 of us paid 4 and 5 and 6 for 7 and left at 8, which is what it is and then some"),
        (19, None),
        (20, ""),
    ]
    path = str(tmp_path_factory.mktemp("templates") / "docs")
    spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1).write.parquet(path)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    result = decontaminate.contaminated(spark.read.parquet(path), items).collect()
    return {(row.id, row.item): row for row in result}


def test_other_figures_are_found(found):
    assert set(found) == {(10, 1), (11, 2), (12, 3), (14, 4), (15, 5), (17, 6)}
    assert found[10, 1].changed and found[11, 2].changed and found[15, 5].changed
    assert not found[17, 6].changed


def test_a_word_or_two_match_whole_documents_only(found):
    assert found[12, 3].longest == 1 and found[14, 4].longest == 2 and found[12, 3].share == 1.0
