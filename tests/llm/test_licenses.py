"""The licence scan against a plain version: words, phrases, tags and evaluated expressions."""

import itertools
import random
import re

import pytest

from tallyworks.llm import licenses, queries
from tests.conftest import DATA_DIR

NAMES = {"mit": "MIT", "apache": "Apache-2.0", "gpl": "GPL-3.0", "isc": "ISC", "unknown": "Foo-1"}


def least_sets(expression):
    """By truth table: the smallest sets of labels under which the expression holds."""
    code = re.sub(r" with \S+?(?=\)| |$)", "", expression)
    for label, name in NAMES.items():
        code = code.replace(name, label)
    holds = []
    for size in range(len(NAMES) + 1):
        for labels in itertools.combinations(NAMES, size):
            values = {label: label in labels for label in NAMES}
            if eval(code, {}, values) and not any(kept <= set(labels) for kept in holds):
                holds.append(set(labels))
    return {frozenset(kept) for kept in holds}


def made_up(rng, depth):
    if not depth or rng.random() < 0.3:
        return rng.choice([*NAMES.values(), "GPL-3.0 with Classpath-exception-2.0"])
    text = f"{made_up(rng, depth - 1)} {rng.choice(['and', 'or'])} {made_up(rng, depth - 1)}"
    return f"({text})" if rng.random() < 0.5 else text


def test_expressions_are_fulfilled_by_the_least_sets():
    rng = random.Random(5)
    for _ in range(500):
        expression = made_up(rng, 4)
        assert licenses.evaluate(expression) == least_sets(expression), expression


@pytest.mark.parametrize("text", ["", "and", "()", "*/"])
def test_unreadable_expressions_name_nothing(text):
    assert not frozenset().union(*licenses.evaluate(text)) - {licenses.UNKNOWN}


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [row for row in sorted(licenses.scan(docs).collect(), key=lambda r: r.id)]


def test_choices_are_shown_and_weigh(spark):
    tag = "SPDX-License-Identifier:"
    either, both, beside, other, twice, none = scanned(
        spark,
        [
            f"# {tag} MIT OR GPL-2.0",
            f"# {tag} MIT AND GPL-2.0",
            f"# {tag} MIT AND LicenseRef-ours",
            "License-Expression: Apache-2.0\r\nmore",
            f"// SPDX-License-Expression: ISC */\n{tag} (MIT OR ISC) AND Apache-2.0",
            f"{tag} LicenseRef-ours",
        ],
    )
    assert either.labels == both.labels == ["gpl", "mit"]
    assert (either.choices, both.choices) == (["gpl or mit"], ["gpl and mit"])
    assert either.score < both.score
    assert beside.labels == ["mit"] and beside.choices == ["mit and unknown"]
    assert beside.score < other.score and other.labels == ["apache"]
    assert twice.choices == ["isc", "apache and isc or apache and mit"]
    assert (none.labels, none.score) == ([], 0.0)


def test_very_long_text(spark):
    words = "license public general " * 200_000
    found = scanned(spark, [words + "mit license " + "x" * 1_000_000])[0]
    assert (found.n_words, found.n_base, found.first_word) == (600_003, 1, 600_000)


def plain(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        parts = phrase.split()
        for at in range(len(words) - len(parts) + 1):
            if words[at : at + len(parts)] == parts:
                places.append(at)
                labels.add(label)
    ends = min(places, default=None), max(places, default=None)
    return (len(words), len(places), *ends, ",".join(sorted(labels)))


def test_query_equals_the_plain_version(spark):
    texts = dict(spark.read.parquet(f"{DATA_DIR}/documents.parquet").select("doc_id", "text").collect())
    found = queries.QUERIES["op9_licenses"](spark, DATA_DIR).collect()
    assert len(found) == len(texts)
    for row in found:
        base = (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels)
        assert base == plain(texts[row.doc_id])
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
        assert 0 <= row.score <= 1 and bool(row.labels) == (row.score > 0)
