"""Licence scans: notices and tags by Aho-Corasick, tag expressions by shunting-yard."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import per_worker, utf8_texts, with_fields

# Words of a notice, and the label they stand for. Fixed values.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Phrases of the method's own; a longer phrase says more than the base phrase in it.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge": "mit",
    "apache software license": "apache",
    "affero general public license": "agpl",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "the unlicense": "unlicense",
    "licensed under cc by nc sa": "cc-by-nc-sa",
    "licensed under cc by nc nd": "cc-by-nc-nd",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nd": "cc-by-nd",
    "licensed under cc by": "cc-by",
    "creative commons attribution": "cc-by",
    "licensed under cc0": "cc0",
    "public domain dedication": "cc0",
    "all rights reserved": "proprietary",
}
# What stands before a licence expression. Fixed values.
TAGS = ("spdx-license-identifier:", "license-expression:", "spdx-license-expression:")
# Starts of licence identifiers and their labels.
TAG_FAMILIES = {
    "mit": "mit",
    "apache": "apache",
    "agpl": "agpl",
    "lgpl": "lgpl",
    "gpl": "gpl",
    "bsd": "bsd",
    "mpl": "mpl",
    "epl": "epl",
    "isc": "isc",
    "bsl": "bsl",
    "unlicense": "unlicense",
    "cc0": "cc0",
    "cc-by": "cc-by",
}
# How far evidence goes to prove a licence: a tag is made for it, a bare name is not. A tag that
# leaves a choice, or asks for terms beside the known ones, says less.
NAME_WEIGHT, NOTICE_WEIGHT, OPEN_WEIGHT, TAG_WEIGHT = 0.6, 0.8, 0.9, 0.95
UNKNOWN = "unknown"

# bytes.translate keeps 0-9, a-z and everything beyond ASCII, and blanks the rest.
_WORD_BYTES = bytes(
    byte if byte >= 0x80 or chr(byte).isalnum() else 0x20 for byte in range(256)
)
_PIECE = re.compile(r"[()]|[^\s()]+")
_LINE = re.compile(rb"[^\r\n]*")
_BINDING = {"or": 1, "and": 2, "with": 3}


def postfix(expression: str) -> list[str]:
    """A licence expression in postfix order, as far as it can be read.

    ``with`` binds closest, then ``and``, then ``or``. Reading ends where two names follow each
    other, an operator lacks its left side, or a bracket closes that was not opened; operators
    that still wait for a right side, and open brackets, are dropped.
    """
    output: list[str] = []
    waiting: list[str] = []
    wants_name = True
    for piece in _PIECE.findall(expression.lower()):
        if piece in _BINDING:
            if wants_name:
                break
            while waiting and _BINDING.get(waiting[-1], 0) >= _BINDING[piece]:
                output.append(waiting.pop())
            waiting.append(piece)
            wants_name = True
        elif piece == "(":
            if not wants_name:
                break
            waiting.append(piece)
        elif piece == ")":
            if wants_name or "(" not in waiting:
                break
            while (top := waiting.pop()) != "(":
                output.append(top)
        else:
            if not wants_name:
                break
            output.append(piece)
            wants_name = False
    if wants_name and output:
        while waiting and waiting[-1] == "(":
            waiting.pop()
        if waiting:
            waiting.pop()
    output += [piece for piece in reversed(waiting) if piece != "("]
    return output


def family(identifier: str) -> str | None:
    name = identifier.rstrip("+.,;")
    for start, label in TAG_FAMILIES.items():
        if name == start or name.startswith(start + "-"):
            return label
    return None


def least(alternatives: set[frozenset[str]]) -> set[frozenset[str]]:
    """The alternatives without those that ask for all of another one, and more."""
    kept: list[frozenset[str]] = []
    for found in sorted(alternatives, key=len):
        if not any(other <= found for other in kept):
            kept.append(found)
    return set(kept)


def evaluate(expression: str) -> set[frozenset[str]]:
    """The least sets of labels whose terms fulfil an expression, any one of them.

    ``a or b`` is fulfilled by either, ``a and b`` by both only; ``a with x`` by a, for x is an
    exception. An identifier of no known family is ``unknown``. Nothing readable: no set.
    """
    stack: list[set[frozenset[str]]] = []
    for piece in postfix(expression):
        if piece not in _BINDING:
            stack.append({frozenset([family(piece) or UNKNOWN])})
            continue
        if len(stack) < 2:
            break
        right, left = stack.pop(), stack.pop()
        if piece == "with":
            stack.append(left)
        elif piece == "or":
            stack.append(least(left | right))
        else:
            stack.append(least({one | other for one in left for other in right}))
    return stack[-1] if stack else set()


def shown(alternatives: set[frozenset[str]]) -> str:
    """Alternatives as text, in order: ``apache and gpl or gpl and mit``."""
    return " or ".join(sorted(" and ".join(sorted(labels)) for labels in alternatives))


class Scanner:
    """Finds phrases as whole words, and identifier tags, in one UTF-8 text."""

    def __init__(self) -> None:
        phrases = {**BASE_PHRASES, **NOTICE_PHRASES}
        # pyahocorasick matches text; Latin-1 carries the UTF-8 bytes one to one.
        self.phrases = ahocorasick.Automaton()
        for phrase, label in phrases.items():
            base = phrase in BASE_PHRASES
            self.phrases.add_word(f" {phrase} ", (len(phrase) + 2, label, base))
        self.phrases.make_automaton()
        self.tags = ahocorasick.Automaton()
        for tag in TAGS:
            self.tags.add_word(tag, tag)
        self.tags.make_automaton()

    def expressions(self, lowered: bytes) -> Iterator[str]:
        """What follows the tags of a text, to the end of the line."""
        done = -1
        for end, _ in self.tags.iter(lowered.decode("latin-1")):
            # Tags that end alike are found together.
            if end == done:
                continue
            done = end
            rest = _LINE.match(lowered, end + 1)
            yield rest[0].decode("utf-8", "replace").strip()

    def scan(self, text: bytes) -> tuple:
        lowered = text.lower()
        words = lowered.translate(_WORD_BYTES).split()
        line = f" {b' '.join(words).decode('latin-1')} "
        starts, base, weight = [], set(), 0.0
        at, counted = 0, 0
        longest: dict[int, tuple[int, str]] = {}  # of the method's own phrases, by their begins
        for end, (length, label, is_base) in self.phrases.iter(line):
            begin = end + 1 - length
            if is_base:
                # Matches come by their ends, and base phrases are short: begins may step back.
                counted += line.count(" ", at, begin) if begin >= at else -line.count(" ", begin, at)
                at = begin
                starts.append(counted)
                base.add(label)
            else:
                longest[begin] = max(longest.get(begin, (0, "")), (length, label))
            weight = max(weight, NAME_WEIGHT if is_base else NOTICE_WEIGHT)
        labels = base | {label for _, label in longest.values()}
        expressions, choices = [], []
        for expression in self.expressions(lowered):
            alternatives = evaluate(expression)
            named = frozenset().union(*alternatives)
            if named - {UNKNOWN}:
                labels |= named - {UNKNOWN}
                settled = len(alternatives) == 1 and UNKNOWN not in named
                weight = max(weight, TAG_WEIGHT if settled else OPEN_WEIGHT)
                expressions.append(" ".join(postfix(expression)))
                choices.append(shown(alternatives))
        # Further kinds of evidence leave less doubt, but never none.
        score = 1 - (1 - weight) * 0.9 ** max(0, len(starts) + len(expressions) - 1)
        return (
            len(words),
            len(starts),
            min(starts, default=None),
            max(starts, default=None),
            sorted(base),
            sorted(labels),
            expressions,
            choices,
            score if labels else 0.0,
        )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, and what its text says about licences.

    ``n_words``; ``n_base``, ``first_word``, ``last_word``: places of the base phrases;
    ``base_labels`` and ``labels``: arrays, sorted; ``expressions``: tag expressions in postfix
    order; ``choices``: what each comes to, the least sets of labels that fulfil it; ``score``: 0
    to 1, 0 without any label, less where a tag leaves a choice. A NULL or empty text has no words, no places
    (NULL) and no labels. Overlapping phrases all count.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = with_fields(
        rows.select("id").schema,
        "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
        "labels array<string>, expressions array<string>, choices array<string>, score double",
    )
    arrow = [
        *[pa.int64()] * 4,
        *[pa.list_(pa.string())] * 4,
        pa.float64(),
    ]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = per_worker("licence scanner", Scanner)
        for batch in batches:
            found = list(zip(*map(scanner.scan, utf8_texts(batch.column(1))))) or [()] * len(arrow)
            columns = [pa.array(values, kind) for values, kind in zip(found, arrow)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    return rows.mapInArrow(work, schema)
