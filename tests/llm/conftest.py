import pytest

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "en"),
    (3, None, None),
    (4, "", "en"),
    (5, "   \n\t ", "fr"),
    (6, "word", "en"),
    (7, "été à l'ombre, 日本語 🙂 <|endoftext|> don't İ", "fr"),
    (8, "a b " * 5000, "en"),
    (9, "x" * 3000, None),
    (10, "Mail me: joe.doe@example.com or +1 (988) 555-2485, card 4111 1111 1111 1111.", "en"),
    (10, "Mail me: joe.doe@example.com or +1 (988) 555-2485, card 4111 1111 1111 1111.", "en"),
    (None, "der Hund und die Katze sind nicht in dem Haus von der Frau", "de"),
    (12, "Der Hund und die Katze sind nicht in dem Haus von der Frau mit dem Auto", "de"),
    (13, "le chat et le chien sont dans la maison de la dame qui est sur la route", "fr"),
]
SCHEMA = "doc_id bigint, text string, lang string"


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """Texts with every oddity, in files; other columns have names that operators use too."""
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    rows = spark.createDataFrame(TEXTS, SCHEMA).selectExpr(
        "doc_id", "text", "lang", "'x' AS id", "1 AS row", "2 AS chunk", "'y' AS fingerprint",
        "'z' AS words", "0 AS bucket",
    )
    rows.coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
