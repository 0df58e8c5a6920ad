"""Personal data against the plain patterns, and cards that stand side by side."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyworks.llm import pii, queries
from tests.conftest import DATA_DIR

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def digits(text):
    return re.sub("[^0-9]", "", text)


def checks(number):
    total = 0
    for at, digit in enumerate(reversed(number)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def holds(kind, found):
    number = digits(found)
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "card":
        return 16 <= len(number) <= 19 and checks(number)
    return kind == "email" or 8 <= len(number) <= 15


def plain(text):
    """Base spans straight from the patterns."""
    return [
        (kind, *found.span())
        for kind, pattern in PATTERNS.items()
        for found in re.finditer(pattern, text or "")
        if holds(kind, found[0])
    ]


def test_query_equals_the_plain_patterns(spark):
    rows = spark.read.parquet(f"{DATA_DIR}/documents.parquet").select("doc_id", "text")
    texts = dict(rows.collect())
    found = queries.QUERIES["op4_pii"](spark, DATA_DIR).collect()
    assert len(found) == len(texts)
    kinds = set()
    for row in found:
        base = plain(texts[row.doc_id])
        kinds |= {kind for kind, _, _ in base}
        printed = ",".join(f"{kind}:{start}:{end}" for kind, start, end in base)
        assert row.base_sha256 == hashlib.sha256(printed.encode()).hexdigest()
        for kind in PATTERNS:
            assert row[f"n_{kind}"] == sum(one == kind for one, _, _ in base)
        assert set(filter(None, printed.split(","))) <= set(row.spans.split(","))
    assert kinds


def test_base_spans_of_odd_texts():
    draw = random.Random(7)
    pieces = ["1.2.3.4", "999.1.1.1", "4111 1111 1111 1111", "a@b.c", "@", "+1 (2) ", " ", "-", ".", "0", "x"]
    for _ in range(3000):
        text = "".join(draw.choices(pieces, k=12))
        base = [(s.kind, s.start, s.end) for s in pii.propose(text) if s.base]
        assert base == plain(text), text


@pytest.fixture(scope="module")
def cards():
    draw = random.Random(11)

    def card():
        body = "4" + "".join(draw.choices("0123456789", k=14))
        number = next(body + last for last in "0123456789" if checks(body + last))
        return " ".join(number[at : at + 4] for at in range(0, 16, 4))

    return [card() for _ in range(60)]


def side_by_side(cards):
    """A pair that makes one run of 32 digits."""
    return next(f"{a} {b}" for a in cards for b in cards if a != b)


def test_cards_side_by_side_are_told_apart(spark, cards):
    pair = side_by_side(cards)
    texts = [f"pay by card {card} today" for card in cards]
    texts += [f"my credit cards: {pair}, thanks", f"card since 2024 {cards[0]}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    clashing = docs.withColumn("_spans", F.lit("kept")).withColumn("_SPANS_", F.lit(1))
    masked = {r.doc_id: r for r in pii.masked(clashing).collect()}
    assert masked[len(cards)].text == "my credit cards: <card> <card>, thanks"
    assert masked[len(cards) + 1].text == "card since 2024 <card>"
    assert masked[0]._spans == "kept" and masked[0]["_SPANS_"] == 1


def test_long_runs_of_digits_end():
    # No checksum holds for a run of ones and its groups; a long run must not take long.
    assert [s for s in pii.propose("1" * 200_000) if s.kind == "card"] == []
    assert [s for s in pii.propose("1111 " * 50_000) if s.kind == "card"] == []
