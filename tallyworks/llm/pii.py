"""Personal data by weak supervision.

Patterns propose spans. Four labelers vote on each: the strict pattern, a checksum or form test, a
gazetteer, and the words before the span. Expectation-maximisation estimates how reliable each
labeler is, from how they agree; its beliefs are the soft labels from which a logistic span
classifier is trained. Spans of the strict patterns (the base) always stay; the classifier decides
about the others.

All that is learned comes from counts of *cells*: kind, votes and shape of a span. There are at
most ``len(KINDS) * 81 * 12`` of them, whatever the corpus.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import with_fields

BASE_KINDS = ("email", "ip", "card", "phone")
# Secrets only come from the method, never from the base.
KINDS = (*BASE_KINDS, "secret")
LABELERS = 4
ACCEPTED = 0.5

# Shapes of the base kinds. Fixed values; possessive, as no shorter match could succeed.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Shapes that only propose.
_CARD_GROUPS = re.compile(
    r"(?<![0-9])(?:[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{5})"
    r"(?![0-9])"
)
_SPELLED_SIGN = re.compile(
    r" ?(?:\(at\)|\[at\])(?= ?([A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]++)++))"
)
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9-])")
_SECRET_NAMES = ("password", "passwd", "token", "secret", "api_key", "api-key", "apikey")
_SECRET = re.compile(
    r"(?:password|passwd|token|secret|api[_-]?key)[ \t]{0,3}[=:][ \t]{0,3}[\"']?"
    r"([A-Za-z0-9+/_-]{8,}+)",
    re.IGNORECASE,
)

# Gazetteers: top-level domains, first digits of card numbers.
_DOMAIN_ENDS = frozenset(
    "com org net edu gov mil info io de fr es it uk us ca au jp cn in br nl ch at be eu".split()
)
_CARD_STARTS = ("3", "4", "5", "6")
_CONTEXT = 40
_SUPPORT = {
    "email": re.compile(r"mail|contact|write|reach|address"),
    "ip": re.compile(r"\bip\b|host|server|address|client|login"),
    "card": re.compile(r"card|visa|master|amex|credit|debit|payment"),
    "phone": re.compile(r"phone|tel\b|call|mobile|fax|cell|contact"),
    "secret": re.compile(r"pass|token|secret|key|login|credential"),
}
_AGAINST = re.compile(r"version|chapter|page|isbn|order|serial|section|figure|table|\bid\b")


def luhn(digits: str) -> bool:
    values = [int(digit) for digit in reversed(digits)]
    doubled = sum(sum(divmod(2 * value, 10)) for value in values[1::2])
    return (sum(values[::2]) + doubled) % 10 == 0


def _local_start(text: str, at: int, done: int) -> int:
    """Where the whole run of characters of a mail address before ``at`` starts."""
    back = 64
    while True:
        begin = max(done, at - back)
        before = text[begin:at]
        local = len(before) - len(before.rstrip(_LOCAL))
        if local < len(before) or begin == done:
            return at - local
        back *= 8


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A mail address starts with the whole run of allowed characters before its sign."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = _local_start(text, at, done)
        if start < at and (found := _DOMAIN.match(text, at)):
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _spelled_emails(text: str) -> Iterator[tuple[int, int]]:
    """The same with its sign, and perhaps its dots, spelled out."""
    done = 0
    for sign in _SPELLED_SIGN.finditer(text):
        start = _local_start(text, sign.start(), done)
        if start < sign.start():
            done = sign.end(1)
            yield start, done


def _grouped_cards(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Numbers written in the groups of a card that pass the checksum, inside a run of digits.

    So cards are told apart that stand side by side, or beside another number.
    """
    while found := _CARD_GROUPS.search(text, start, end):
        if luhn(_digits(found[0])):
            yield found.span()
            start = found.end()
        else:
            start = found.start() + 1


def _is_ip(text: str) -> bool:
    parts = (part.lstrip("0") for part in text.split("."))
    return all(len(part) <= 3 and int(part or "0") <= 255 for part in parts)


def _digits(text: str) -> str:
    return "".join(filter(str.isdecimal, text))


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    base: bool
    cell: int


def _cell(kind: str, votes: tuple[int, ...], shape: int) -> int:
    code = KINDS.index(kind)
    for vote in votes:
        code = code * 3 + vote + 1
    return code * 12 + shape


def _shape(text: str) -> int:
    """Length in four classes, share of digits in three."""
    length = min(3, len(text) // 10)
    share = sum(map(str.isdecimal, text)) / len(text)
    return length * 3 + (0 if share < 0.3 else 1 if share < 0.8 else 2)


def _span(text: str, kind: str, start: int, end: int, base: bool) -> Span:
    found = text[start:end]
    before = text[max(0, start - _CONTEXT) : start].lower()
    form, known = 0, 0
    if kind == "email":
        last = re.split(r"[.\s\])]+", found)[-1].lower()
        form = 1 if base else 0
        known = 1 if last in _DOMAIN_ENDS else -1
    elif kind == "ip":
        form = 1 if _is_ip(found) else -1
        known = -1 if found.startswith(("0.", "127.", "255.")) else 0
    elif kind == "card":
        digits = _digits(found)
        form = 1 if luhn(digits) else -1
        known = 1 if digits.startswith(_CARD_STARTS) else -1
    elif kind == "phone":
        digits = _digits(found)
        form = 1 if 10 <= len(digits) <= 15 else 0
        known = 1 if len(set(digits)) > 3 else -1
    else:
        mixed = any(map(str.isdecimal, found)) and any(map(str.isalpha, found))
        form = 1 if mixed and len(found) >= 12 else -1
        known = 1 if found.lower() not in ("undefined", "required", "optional") else -1
    context = 1 if _SUPPORT[kind].search(before) else -1 if _AGAINST.search(before) else 0
    return Span(kind, start, end, base, _cell(kind, (1 if base else -1, form, known, context), _shape(found)))


def propose(text: str) -> list[Span]:
    """Base spans, and spans of looser patterns that overlap none of them, in order."""
    base: dict[str, list[tuple[int, int]]] = {kind: [] for kind in BASE_KINDS}
    loose: list[tuple[str, int, int]] = []
    if "@" in text:
        base["email"] = list(_emails(text))
    if _HAS_DIGIT.search(text):
        for found in _IP.finditer(text):
            if _is_ip(found[0]):
                base["ip"].append(found.span())
        for found in _CARD.finditer(text):
            digits = _digits(found[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                base["card"].append(found.span())
                continue
            inside = list(_grouped_cards(text, *found.span())) if len(digits) > 16 else []
            if not inside and 14 <= len(digits) <= 19:
                inside = [found.span()]
            loose += [("card", *span) for span in inside]
        if "+" in text:
            for found in _PHONE.finditer(text):
                if 8 <= len(_digits(found[0])) <= 15:
                    base["phone"].append(found.span())
        loose += [("phone", *found.span()) for found in _LOCAL_PHONE.finditer(text)]
    if "(at)" in text or "[at]" in text:
        loose += [("email", *found) for found in _spelled_emails(text)]
    lowered = text.lower()
    if any(name in lowered for name in _SECRET_NAMES):
        loose += [("secret", *found.span(1)) for found in _SECRET.finditer(text)]
    spans = [_span(text, kind, *at, True) for kind in BASE_KINDS for at in base[kind]]
    if loose:
        taken = sorted(at for places in base.values() for at in places)
        for kind, start, end in sorted(loose, key=lambda span: (span[1], -span[2])):
            place = _after(taken, start)
            if (place and taken[place - 1][1] > start) or (
                place < len(taken) and taken[place][0] < end
            ):
                continue
            taken.insert(place, (start, end))
            spans.append(_span(text, kind, start, end, False))
    spans.sort(key=lambda span: (KINDS.index(span.kind), span.start))
    return spans


_HAS_DIGIT = re.compile(r"[0-9]")


def _after(taken: list[tuple[int, int]], start: int) -> int:
    low, high = 0, len(taken)
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if taken[middle][0] <= start else (low, middle)
    return low


def count_cells(docs: DataFrame, text_col: str) -> dict[int, int]:
    """How many proposed spans fall into each cell, over all texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(span.cell for span in propose(text or ""))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
            ["cell", "n"],
        )

    counted = docs.select(text_col).mapInArrow(work, "cell long, n long")
    summed = counted.groupBy("cell").agg(F.sum("n").alias("n"))
    # Bounded by the number of cells.
    return {row.cell: row.n for row in summed.collect()}


def _taken_apart(cell: int) -> tuple[int, list[int], int]:
    code, shape = divmod(cell, 12)
    votes = []
    for _ in range(LABELERS):
        code, vote = divmod(code, 3)
        votes.insert(0, vote)
    return code, votes, shape


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Chance that a span is real, for each row of votes (0 against, 1 abstains, 2 for).

    Two hidden classes with independent labelers; starts from the plain majority.
    """
    belief = 1 / (1 + np.exp(-(votes - 1.0).sum(axis=1)))
    for _ in range(rounds):
        weights = np.stack([(1 - belief) * counts, belief * counts])
        prior = (weights.sum(axis=1) + 1) / (counts.sum() + 2)
        logs = np.tile(np.log(prior)[:, None], len(votes))
        for labeler in range(votes.shape[1]):
            table = np.stack(
                [np.bincount(votes[:, labeler], weight, 3) + 0.5 for weight in weights]
            )
            table /= table.sum(axis=1, keepdims=True)
            logs += np.log(table[:, votes[:, labeler]])
        belief = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
    return belief


def _features(cells: list[int]) -> np.ndarray:
    rows = np.zeros((len(cells), len(KINDS) + 3 * LABELERS + 12))
    for at, (kind, votes, shape) in enumerate(map(_taken_apart, cells)):
        rows[at, kind] = 1
        for labeler, vote in enumerate(votes):
            rows[at, len(KINDS) + 3 * labeler + vote] = 1
        rows[at, len(KINDS) + 3 * LABELERS + shape] = 1
    return rows


def train(counts: Mapping[int, int]) -> dict[int, float]:
    """The classifier's score for every possible cell.

    Beliefs are estimated kind by kind, then one logistic model is fitted to them over kind, votes
    and shape, by gradient steps with a small penalty. Without any span all scores are 0.
    """
    every = [_cell(kind, votes, shape) for kind in KINDS for votes in _ALL_VOTES for shape in range(12)]
    if not counts:
        return dict.fromkeys(every, 0.0)
    cells = sorted(counts)
    weight = np.array([counts[cell] for cell in cells], float)
    parts = [_taken_apart(cell) for cell in cells]
    kinds = np.array([kind for kind, _, _ in parts])
    votes = np.array([votes for _, votes, _ in parts])
    target = np.zeros(len(cells))
    for kind in set(kinds.tolist()):
        mine = kinds == kind
        target[mine] = reliabilities(votes[mine], weight[mine])
    rows = _features(cells)
    # Frequent cells count more, but do not drown the others.
    share = np.sqrt(weight) / np.sqrt(weight).sum()
    slopes = np.zeros(rows.shape[1])
    for _ in range(3000):
        chance = 1 / (1 + np.exp(-rows @ slopes))
        slopes -= 2.0 * (rows.T @ (share * (chance - target)) + 1e-4 * slopes)
    scores = 1 / (1 + np.exp(-_features(every) @ slopes))
    return dict(zip(every, scores.tolist()))


_ALL_VOTES = [
    (a, b, c, d) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) for d in (-1, 0, 1)
]


def detect(docs: DataFrame, *, text_col: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with a list of spans: ``kind``, ``start``, ``end``, ``base``, ``score``.

    Places are code points, the end exclusive; spans are ordered by kind (as in ``KINDS``) and
    start. Base spans of different kinds may overlap; added ones overlap nothing. NULL and empty
    texts have none. The model is learned from all texts of ``docs`` first. A column of the name
    ``out`` is replaced.
    """
    scores = train(count_cells(docs, text_col))
    rows = docs.drop(out)
    kind = "array<struct<kind: string, start: long, end: long, base: boolean, score: double>>"
    schema = with_fields(rows.schema, f"`{out}` {kind}")
    place = rows.columns.index(text_col)
    span_type = pa.list_(
        pa.struct(
            [
                ("kind", pa.string()),
                ("start", pa.int64()),
                ("end", pa.int64()),
                ("base", pa.bool_()),
                ("score", pa.float64()),
            ]
        )
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [
                    (span.kind, span.start, span.end, span.base, scores[span.cell])
                    for span in propose(text or "")
                    if span.base or scores[span.cell] >= ACCEPTED
                ]
                for text in batch.column(place).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, span_type)], schema.names
            )

    return rows.mapInArrow(work, schema)


def masked(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in the text replaced by its kind in angle brackets.

    Overlapping spans become one, named after the first. Texts without spans stay as they are.
    """
    spare = "_spans"
    while spare in map(str.lower, docs.columns):
        spare += "_"
    found = detect(docs, text_col=text_col, out=spare)
    place = docs.columns.index(text_col)
    size = len(docs.columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            pairs = zip(batch.column(place).to_pylist(), batch.column(size).to_pylist())
            for text, spans in pairs:
                if spans:
                    parts, done = [], 0
                    for span in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                        if span["start"] >= done:
                            parts += [text[done : span["start"]], f"<{span['kind']}>"]
                        done = max(done, span["end"])
                    text = "".join([*parts, text[done:]])
                texts.append(text)
            columns = batch.columns[:size]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:size])

    return found.mapInArrow(work, docs.schema)
