"""Alignment of two tokenizers over whole texts.

Both tokenizers cut the same bytes (a space and the text). Where a token of one and a token of the
other end at the same byte, a group ends: the shorter list of ends is walked, and each of its ends
is looked for in the longer list by galloping (steps that double, then a binary search between the
last two). The places of the common ends cut both token lists into groups; a group's tokens are
all linked with each other. How many documents of the corpus hold a pair of ids linked tells
which tokens stand for the same text.

A text is cut before a space that follows a plain letter, digit or mark. No token of either kind
reaches over such a place, so each different word of a batch is aligned once, all in one go.
Each task counts the pairs of its documents by chunks of about ``CHUNK_PAIRS`` pairs; the counts are
summed in Spark, and each chunk gets back those of its own pairs, whatever the corpus holds.

Defined cases: texts that are NULL, empty, or whose tokens don't give back their bytes (for one,
a text with U+2581, which the second tokenizer can't tell from a space) have no tokens: all zero,
and an empty ``groups``. Rows that repeat, or have one id, are documents of their own.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tallyworks.llm.bpe import byte_symbols, ranges
from tallyworks.llm.common import per_worker, with_fields
from tallyworks.session import keep_table

# Different (document, pair) entries that are counted together.
CHUNK_PAIRS = 1 << 20
# A longer word is encoded by a library that does it in less than quadratic time.
_LONG_UNIT = 2048
# A group with more links has each different pair worked out once.
_MANY_LINKS = 4096

# Fixed value: how byte-level vocabularies of this kind cut a text into words.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT = regex.compile(rb"(?:(?<=[!-~])|(?<=\xC3[\x80-\xBF])) (?=[\x00-\xFF])")
_B_BITS = 16


def gallop(
    values: np.ndarray, longer: np.ndarray, start: np.ndarray, stop: np.ndarray
) -> np.ndarray:
    """For each value the first place from its ``start`` on where ``longer`` is not below it.

    The steps double until they pass the value or reach ``stop``; then a binary search goes on
    between the last two. All values take their steps at once.
    """
    low, high = start.copy(), start.copy()
    live = np.arange(len(values))
    step = 1
    while len(live):
        live = live[high[live] < stop[live]]
        live = live[longer[high[live]] < values[live]]
        low[live] = high[live] + 1
        high[live] = np.minimum(high[live] + step, stop[live])
        step *= 2
    live = np.flatnonzero(low < high)
    while len(live):
        middle = (low[live] + high[live]) // 2
        below = longer[middle] < values[live]
        low[live[below]] = middle[below] + 1
        high[live[~below]] = middle[~below]
        live = live[low[live] < high[live]]
    return low


def common_ends(
    first: np.ndarray, second: np.ndarray, n_first: np.ndarray, n_second: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ends that both lists have, word by word.

    ``first`` and ``second`` are the ends of all words' tokens, ``n_first`` and ``n_second`` how
    many each word has. The list that is shorter in a word drives the search in the other.
    """
    found = []
    drives = n_first <= n_second
    sides = (first, second, n_first, n_second, drives), (second, first, n_second, n_first, ~drives)
    for short, long, n_short, n_long, mine in sides:
        each = n_short[mine]
        at = ranges((np.cumsum(n_short) - n_short)[mine], each)
        stop = np.cumsum(n_long)[mine]
        place = gallop(
            short[at], long, np.repeat(stop - n_long[mine], each), stop := np.repeat(stop, each)
        )
        hit = np.flatnonzero(place < stop)
        hit = hit[long[place[hit]] == short[at[hit]]]
        found.append((at[hit], place[hit]))
    (a, b), (d, c) = found
    a, b = np.concatenate([a, c]), np.concatenate([b, d])
    order = np.argsort(a)
    return a[order], b[order]


def byte_ranks(file_text: str) -> dict[bytes, int]:
    """Ids of a byte-level vocabulary's entries, which are also the ranks of their merges."""
    described = json.loads(file_text)
    byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
    special = {token["content"] for token in described["added_tokens"]}
    ids = described["model"]["vocab"]
    merges = (pair if isinstance(pair, list) else pair.split(" ") for pair in described["model"]["merges"])
    made = [ids[left + right] for left, right in merges]
    if made != sorted(set(made)):
        raise ValueError("the vocabulary's ids are not in the order of its merges")
    return {
        bytes(byte_of[symbol] for symbol in name): number
        for name, number in ids.items()
        if name not in special
    }


class Aligner:
    """Two tokenizers, and the bytes of their tokens."""

    def __init__(self, first_file: str, second_model: bytes) -> None:
        ranks = byte_ranks(first_file)
        self.first = tiktoken.Encoding(
            "first", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}
        )
        self.first_file, self.first_long = first_file, None
        self.second = SentencePieceProcessor(model_proto=second_model)
        self.first_bytes = [b""] * (max(ranks.values()) + 1)
        for name, number in ranks.items():
            self.first_bytes[number] = name
        self.second_bytes = [self._piece(at) for at in range(self.second.get_piece_size())]
        if len(self.second_bytes) > 1 << _B_BITS:
            raise ValueError(f"the second vocabulary has over {1 << _B_BITS} pieces")
        self.sizes = [
            np.fromiter(map(len, names), np.int64, len(names))
            for names in (self.first_bytes, self.second_bytes)
        ]
        most = max(map(len, self.sizes))
        self.decimal = list(map(str, range(most)))

    def _piece(self, number: int) -> bytes:
        piece = self.second.id_to_piece(number)
        if self.second.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def first_ids(self, text: str) -> list[int]:
        if len(text) <= _LONG_UNIT:
            return self.first.encode_ordinary(text)
        if self.first_long is None:
            # This library sorts the merges of a long word; few workers meet one.
            self.first_long = Tokenizer.from_str(self.first_file)
            # The special tokens' strings in a text are then ordinary text.
            self.first_long.encode_special_tokens = True
        return self.first_long.encode(text, add_special_tokens=False).ids

    def ids(self, units: list[bytes]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of each word by both, none where its bytes don't come back, and which these are."""
        texts = [unit.decode() for unit in units]
        first = [self.first_ids(" " + text) for text in texts]
        second = self.second.encode(texts, num_threads=1)
        amiss = np.zeros(len(units), bool)
        # Bytes always come back from the first, whose entries are the bytes themselves.
        names = self.second_bytes.__getitem__
        whole = b"".join(b" " + unit for unit in units)
        if b"".join(map(names, chain.from_iterable(second))) != whole:
            for at, unit in enumerate(units):
                if b"".join(map(names, second[at])) != b" " + unit:
                    amiss[at] = True
                    first[at], second[at] = [], []
        return first, second, amiss


class Words:
    """Alignments of different words: counts, the ids by group as text, and the linked pairs."""

    def __init__(self, aligner: Aligner, units: list[bytes]) -> None:
        first, second, self.amiss = aligner.ids(units)
        self.n_a, self.n_b = (
            np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (first, second)
        )
        a = np.fromiter(chain(*first), np.int64, self.n_a.sum())
        b = np.fromiter(chain(*second), np.int64, self.n_b.sum())
        ends_a, ends_b = (np.cumsum(size[ids]) for size, ids in zip(aligner.sizes, (a, b)))
        last_a, last_b = common_ends(ends_a, ends_b, self.n_a, self.n_b)
        stop_a, stop_b = last_a + 1, last_b + 1
        start_a, start_b = np.append(0, stop_a)[:-1], np.append(0, stop_b)[:-1]
        size_a, size_b = stop_a - start_a, stop_b - start_b
        unit = np.repeat(np.arange(len(units)), self.n_a)[last_a]
        self.n_groups = np.bincount(unit, minlength=len(units))
        links = size_a * size_b
        self.n_links = np.zeros(len(units), np.int64)
        np.add.at(self.n_links, unit, links)

        names_a = [aligner.decimal[one] for one in chain(*first)]
        names_b = [aligner.decimal[one] for one in chain(*second)]
        printed = [
            f"{names_a[i]}|{names_b[k]}"
            if j - i == 1 == m - k
            else f"{','.join(names_a[i:j])}|{','.join(names_b[k:m])}"
            for i, j, k, m in zip(*(x.tolist() for x in (start_a, stop_a, start_b, stop_b)))
        ]
        ends = np.cumsum(self.n_groups).tolist()
        self.texts = [";".join(printed[low:high]) for low, high in zip([0, *ends], ends)]

        small = np.flatnonzero(links <= _MANY_LINKS)
        each = links[small]
        within = ranges(np.zeros(len(small), np.int64), each)
        row, column = np.divmod(within, np.repeat(size_b[small], each))
        left = a[np.repeat(start_a[small], each) + row]
        right = b[np.repeat(start_b[small], each) + column]
        units_, codes, times = [np.repeat(unit[small], each)], [left << _B_BITS | right], []
        times.append(np.ones(len(left), np.int64))
        for at in np.flatnonzero(links > _MANY_LINKS):
            # Of a long group, each different pair once with its number.
            some, n_some = np.unique(a[start_a[at] : stop_a[at]], return_counts=True)
            other, n_other = np.unique(b[start_b[at] : stop_b[at]], return_counts=True)
            codes.append((some[:, None] << _B_BITS | other).ravel())
            times.append(np.outer(n_some, n_other).ravel())
            units_.append(np.full(len(codes[-1]), unit[at]))
        of = np.concatenate(units_)
        order = np.argsort(of, kind="stable")
        self.codes, self.times = np.concatenate(codes)[order], np.concatenate(times)[order]
        self.sizes = np.bincount(of, minlength=len(units))
        self.starts = np.cumsum(self.sizes) - self.sizes


class _Documents:
    """The alignments of a batch of texts, by the words they are made of."""

    def __init__(self, aligner: Aligner, texts: list[bytes | None]) -> None:
        cut = [_CUT.split(text) if text else [] for text in texts]
        units = list(dict.fromkeys(chain.from_iterable(cut)))
        words = Words(aligner, units)
        numbers = dict(zip(units, range(len(units))))
        text_of = dict(zip(units, words.texts)).__getitem__
        count, each = len(texts), list(map(len, cut))
        owners = np.repeat(np.arange(count), each)
        flat = map(numbers.__getitem__, chain.from_iterable(cut))
        flat = np.fromiter(flat, np.int64, len(owners))
        # A document with a word whose bytes differ has no tokens.
        amiss = np.zeros(count, bool)
        amiss[owners[words.amiss[flat]]] = True
        self.groups = [
            hashlib.sha256(";".join(map(text_of, found)).encode()).hexdigest()
            if found and not bad
            else ""
            for found, bad in zip(cut, amiss.tolist())
        ]
        fine = ~amiss[owners]
        owners, flat = owners[fine], flat[fine]
        # Sums of whole numbers, far below what doubles hold exactly.
        self.totals = [
            np.bincount(owners, of[flat], minlength=count).astype(np.int64)
            for of in (words.n_a, words.n_b, words.n_groups, words.n_links)
        ]
        # Words of a document, each once, then their pairs, each once with its links.
        keys, repeats = np.unique(owners * max(1, len(numbers)) + flat, return_counts=True)
        owners, flat = np.divmod(keys, max(1, len(numbers)))
        sizes = words.sizes[flat]
        at = ranges(words.starts[flat], sizes)
        entries = np.repeat(owners, sizes) << 32 | words.codes[at]
        links = np.repeat(repeats, sizes) * words.times[at]
        order = np.argsort(entries, kind="stable")
        entries, links = entries[order], links[order]
        opens = np.flatnonzero(np.append(True, entries[1:] != entries[:-1])[: len(entries)])
        self.links = np.add.reduceat(links, opens) if len(opens) else links
        entries = entries[opens]
        self.owners, self.codes = entries >> 32, entries & ((1 << 32) - 1)


_FIELDS = (
    "chunk long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "pairs array<int>, links array<long>, place int, code long, n long"
)


def _read(first_path: str, second_path: str) -> tuple[str, bytes]:
    with open(first_path, encoding="utf-8") as file, open(second_path, "rb") as model:
        return file.read(), model.read()


def _aligned(rows: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Rows of two kinds, those of a chunk's documents and, with a ``place``, those of its pairs."""
    shared = rows.sparkSession.sparkContext.broadcast(_read(*paths))
    schema = with_fields(rows.select("id").schema, _FIELDS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ("aligner", hash(shared.value))
        aligner = per_worker(key, lambda: Aligner(*shared.value))
        id_type = None
        chunk = TaskContext.get().partitionId() << 32
        held: list[tuple[pa.Array, _Documents]] = []
        size = 0

        def settle() -> Iterator[pa.RecordBatch]:
            codes, place, n = np.unique(
                np.concatenate([docs.codes for _, docs in held]), return_inverse=True, return_counts=True
            )
            place = place.astype(np.int32)
            used = 0
            for ids, docs in held:
                count = len(ids)
                bounds = np.searchsorted(docs.owners, np.arange(count + 1)).astype(np.int32)
                pairs = place[used : used + len(docs.codes)]
                used += len(docs.codes)
                yield batch_of(
                    count,
                    id=ids,
                    n_a=docs.totals[0],
                    n_b=docs.totals[1],
                    n_groups=docs.totals[2],
                    n_links=docs.totals[3],
                    groups=pa.array(docs.groups, pa.string()),
                    pairs=pa.ListArray.from_arrays(pa.array(bounds), pa.array(pairs)),
                    links=pa.ListArray.from_arrays(pa.array(bounds), pa.array(docs.links)),
                )
            for at in range(0, len(codes), 100_000):
                part = slice(at, at + 100_000)
                yield batch_of(
                    len(codes[part]),
                    place=np.arange(at, at + len(codes[part]), dtype=np.int32),
                    code=codes[part],
                    n=n[part],
                )

        def batch_of(count: int, **given) -> pa.RecordBatch:
            types = {"id": id_type, "groups": pa.string(), "place": pa.int32()}
            types |= {"pairs": pa.list_(pa.int32()), "links": pa.list_(pa.int64())}
            given["chunk"] = np.full(count, chunk)
            columns = [
                pa.array(given[name]) if name in given else pa.nulls(count, types.get(name, pa.int64()))
                for name in schema.names
            ]
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            id_type = batch.column(0).type
            docs = _Documents(aligner, batch.column(1).cast(pa.binary()).to_pylist())
            held.append((batch.column(0), docs))
            size += len(docs.codes)
            if size > CHUNK_PAIRS:
                yield from settle()
                held, size = [], 0
                chunk += 1
        if held:
            yield from settle()

    return rows.mapInArrow(work, schema)


def align(
    docs: DataFrame,
    first_path: str,
    second_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The alignment of each document, and the pairs of ids with their counts.

    First, per row: ``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose
    pair has the highest count of its first id, ties included), ``count_sum`` (over links) and
    ``groups`` (SHA-256 of the ids by group). Second: ``a``, ``b``, ``documents``, ``best``.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kept = keep_table(_aligned(rows, (first_path, second_path)))
    pairs = kept.where(F.col("place").isNotNull()).select("chunk", "place", "code", "n")
    a = F.shiftright("code", _B_BITS).cast("int").alias("a")
    counts = pairs.groupBy("code").agg(F.sum("n").alias("documents")).select("*", a)
    # As many rows as the first vocabulary has ids, at most.
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    rated = keep_table(
        counts.join(most, "a").select(
            "a",
            F.col("code").bitwiseAND((1 << _B_BITS) - 1).cast("int").alias("b"),
            "code",
            "documents",
            (F.col("documents") == F.col("most")).alias("best"),
        )
    )
    counted = pairs.select("chunk", "place", "code").join(
        rated.select("code", "documents", "best"), "code"
    ).select(F.col("chunk").alias("of"), "place", "documents", "best")
    texts = kept.where(F.col("place").isNull()).select(
        "chunk", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links"
    )
    schema = with_fields(
        rows.select("id").schema,
        "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string",
    )

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        documents = np.zeros(len(place), np.int64)
        best = np.zeros(len(place), np.int64)
        documents[place] = right.column("documents").to_numpy()
        best[place] = right.column("best").to_numpy()
        pairs = left.column("pairs").combine_chunks()
        sizes = pairs.value_lengths().to_numpy()
        ends = np.cumsum(sizes)
        at = pairs.flatten().to_numpy()
        links = left.column("links").combine_chunks().flatten().to_numpy()

        def summed(values: np.ndarray) -> pa.Array:
            total = np.concatenate(([0], np.cumsum(links * values[at])))
            return pa.array(total[ends] - total[ends - sizes])

        columns = {name: left.column(name) for name in left.column_names}
        columns |= {"n_best": summed(best), "count_sum": summed(documents)}
        return pa.table([columns[name] for name in schema.names], schema.names)

    both = texts.groupBy("chunk").cogroup(counted.groupBy("of"))
    return both.applyInArrow(work, schema), rated.select("a", "b", "documents", "best")
