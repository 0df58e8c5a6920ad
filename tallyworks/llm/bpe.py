"""Byte-pair encoding and decoding by contiguous arrays of ranks.

A word is held as its parts and, beside them, the rank of each pair of neighbours. The
smallest rank is looked for again and again, its right part is deleted, and the ranks on
both sides are looked up anew. Words are short, so scanning a small array beats a heap; a
word of more than ``LONG_WORD`` bytes is merged with a heap instead, to the same result.

The different words of a block of texts are merged side by side: words of one length are the
rows of one array of parts and one of ranks, and each step takes one boundary out of every row
that has one left. Nothing is kept from block to block but the vocabulary.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyworks.llm.common import per_worker, utf8_texts, with_fields

LONG_WORD = 512
# Bytes of text that are encoded together; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

# Longer words, which are rare, are merged one by one.
_SIDE_BY_SIDE = 64

_NO_RANK = 1 << 62
_SHIFT = 20
_LOW = (1 << _SHIFT) - 1


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(byte if byte in printable else next(spare)) for byte in range(256)]


class Vocabulary:
    """A word-level BPE vocabulary: ids of parts, ranks of pairs, special tokens."""

    def __init__(self, file_text: str) -> None:
        described = json.loads(file_text)
        model = described["model"]
        end = model["end_of_word_suffix"]
        ids: dict[str, int] = model["vocab"]
        symbols = byte_symbols()
        self.inner = [ids[symbol] for symbol in symbols]
        self.last = [ids[symbol + end] for symbol in symbols]
        self.inner_ids, self.last_ids = np.array(self.inner), np.array(self.last)
        # A pair of ids leads to its rank and the id of the joined part, in one number.
        self.ranks = {
            ids[left] << _SHIFT | ids[right]: rank << _SHIFT | ids[left + right]
            for rank, (left, right) in enumerate(model["merges"])
        }
        special = {token["content"]: token["id"] for token in described["added_tokens"]}
        self.special = special
        names = {number: text for text, number in {**ids, **special}.items()}
        self.names = [names.get(number, "") for number in range(max(names) + 1)]
        self.split_special = regex.compile(
            "(" + "|".join(map(regex.escape, special)) + ")" if special else r"(?!)()"
        )
        split = described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split, regex.VERSION0)
        # Text beyond Latin-1 is normalised and split as the library does it, whose tables of
        # letters are of another Unicode version than Python's.
        self.library = Tokenizer.from_str(file_text)
        self.byte_of = {symbol: byte for byte, symbol in enumerate(symbols)}
        self._table()

    def _table(self) -> None:
        """The pairs' ranks in a hash table with open addressing, for many look-ups at once."""
        keys = np.fromiter(self.ranks, np.int64, len(self.ranks))
        values = np.fromiter(self.ranks.values(), np.int64, len(self.ranks))
        size = 1 << max(4, (8 * len(keys)).bit_length())
        self.mask = size - 1
        self.pairs, self.found = np.full(size, -1), np.full(size, _NO_RANK)
        at, left, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(left):
            self.probes += 1
            slots = at[left]
            free = self.pairs[slots] < 0
            slots, first = np.unique(slots[free], return_index=True)
            taken = left[free][first]
            self.pairs[slots], self.found[slots] = keys[taken], values[taken]
            left = np.setdiff1d(left, taken)
            at[left] = (at[left] + 1) & self.mask

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(40)).astype(np.int64) & self.mask

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and joined id of pairs, in one number; ``_NO_RANK`` where they aren't joined."""
        pairs = left << _SHIFT | right
        at = self._slot(pairs)
        held = self.pairs[at]
        result = np.where(held == pairs, self.found[at], _NO_RANK)
        rest = np.nonzero((held != pairs) & (held >= 0))
        for _ in range(1, self.probes):
            if not len(rest[0]):
                break
            at[rest] = (at[rest] + 1) & self.mask
            held = self.pairs[at[rest]]
            hit = held == pairs[rest]
            result[rest] = np.where(hit, self.found[at[rest]], _NO_RANK)
            rest = tuple(axis[~hit & (held >= 0)] for axis in rest)
        return result

    def merge_rows(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merge words of one length, the rows of an array of bytes.

        Gives the places of rows that are done, and their ids, as often as some get done.
        """
        parts = self.inner_ids[words]
        parts[:, -1] = self.last_ids[words[:, -1]]
        ranks = self.rank(parts[:, :-1], parts[:, 1:])
        rows = np.arange(len(words))
        while parts.shape[1] > 1:
            at = ranks.argmin(axis=1)
            lowest = ranks[np.arange(len(at)), at]
            done = lowest == _NO_RANK
            if done.any():
                yield rows[done], parts[done]
                rest = ~done
                rows, parts, ranks, at, lowest = (x[rest] for x in (rows, parts, ranks, at, lowest))
            if not len(rows):
                return
            # The boundary goes: all that stands right of it moves one place to the left.
            column = np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, column + (column > at[:, None]), axis=1)
            every = np.arange(len(rows))
            parts[every, at] = lowest & _LOW
            ranks = np.take_along_axis(ranks, column[:-1] + (column[:-1] >= at[:, None]), axis=1)
            for side in (at - 1, at):
                near = np.flatnonzero((side >= 0) & (side < ranks.shape[1]))
                to = side[near]
                ranks[near, to] = self.rank(parts[near, to], parts[near, to + 1])
        if len(rows):
            yield rows, parts

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and how many each word has."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        counts = np.zeros(len(words), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        lengths, opens = np.unique(sizes[order], return_index=True)
        for length, members in zip(lengths.tolist(), np.split(order, opens[1:])):
            if length > _SIDE_BY_SIDE:
                merged = [(at, self.merge(words[at])) for at in members.tolist()]
                done = [(np.array([at]), np.array([ids])) for at, ids in merged]
            else:
                data = b"".join(words[at] for at in members.tolist())
                table = np.frombuffer(data, np.uint8).reshape(-1, length)
                done = [(members[rows], ids) for rows, ids in self.merge_rows(table)]
            for rows, ids in done:
                counts[rows] = ids.shape[1]
                found.append((rows, ids))
        starts = np.cumsum(counts) - counts
        flat = np.zeros(counts.sum(), np.int64)
        for rows, ids in found:
            flat[starts[rows][:, None] + np.arange(ids.shape[1])] = ids
        return flat, counts

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        parts = [self.inner[byte] for byte in word]
        parts[-1] = self.last[word[-1]]
        if len(parts) > LONG_WORD:
            return self._merge_long(parts)
        rank_of = self.ranks.get
        ranks = [rank_of(a << _SHIFT | b, _NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks and (lowest := min(ranks)) != _NO_RANK:
            at = ranks.index(lowest)
            parts[at] = lowest & _LOW
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of(parts[at] << _SHIFT | parts[at + 1], _NO_RANK)
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] << _SHIFT | parts[at], _NO_RANK)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        size, rank_of = len(parts), self.ranks.get
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] < size:
                pair = parts[left] << _SHIFT | parts[after[left]]
                if (rank := rank_of(pair)) is not None:
                    heap.append((rank, left, pair)) if not ready else heapq.heappush(
                        heap, (rank, left, pair)
                    )

        ready = False
        for at in range(size):
            offer(at)
        heapq.heapify(heap)
        ready = True
        while heap:
            rank, left, pair = heapq.heappop(heap)
            right = after[left]
            if parts[left] < 0 or right >= size or parts[left] << _SHIFT | parts[right] != pair:
                continue
            parts[left], parts[right] = rank & _LOW, -1
            after[left] = after[right]
            if after[left] < size:
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return [part for part in parts if part >= 0]

    def split(self, word: bytes) -> list[bytes | int]:
        """What a word between white space is merged in: runs of bytes, ids of special tokens."""
        text = word.decode()
        found: list[bytes | int] = []
        # Special tokens have two signs that few words have.
        parts = self.split_special.split(text) if "|" in text else [text]
        for number, part in enumerate(parts):
            if number % 2:
                found.append(self.special[part])
            elif not part:
                continue
            elif part.isascii() or max(part) < "\u0100":
                found += [run.encode() for run in self.words.findall(part.lower())]
            else:
                plain = self.library.normalizer.normalize_str(part)
                for run, _ in self.library.pre_tokenizer.pre_tokenize_str(plain):
                    found.append(bytes(map(self.byte_of.__getitem__, run)))
        return found

    def decode(self, ids: list[int]) -> str:
        """Names of the parts with a space between, special tokens included."""
        return " ".join(map(self.names.__getitem__, ids))


class WordIds:
    """Ids of the different words of some texts, words being what stands between white space.

    White space ends every word and belongs to none, so a text's ids are those of its words
    in turn. A special token has no white space in it.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary

    def runs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The runs of all words, each different one once, and which of them each word has.

        Ids of the runs and their number for each run; runs, and how many, for each word.
        """
        split = self.vocabulary.split
        # Of bytes, letters are A-Z and a-z only.
        cut = [[word.lower()] if word.isalpha() else split(word) for word in words]
        runs = list(dict.fromkeys(chain.from_iterable(cut)))
        number = dict(zip(runs, range(len(runs))))
        plain = [run for run in runs if type(run) is bytes]
        flat, counts = self.vocabulary.merge_all(plain)
        if len(plain) < len(runs):
            at = np.array([type(run) is bytes for run in runs])
            every = np.ones(len(runs), np.int64)
            every[at] = counts
            ids = np.zeros(every.sum(), np.int64)
            of_plain = np.repeat(at, every)
            ids[of_plain] = flat
            ids[~of_plain] = [run for run in runs if type(run) is int]
            flat, counts = ids, every
        each = np.fromiter(map(len, cut), np.int64, len(cut))
        of = np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.int64, each.sum())
        return flat, counts, of, each

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has."""
        cut = [text.split() for text in texts]
        words = list(dict.fromkeys(chain.from_iterable(cut)))
        flat, counts, of, each = self.runs(words)
        number = dict(zip(words, range(len(words))))
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        at = map(number.__getitem__, chain.from_iterable(cut))
        at = np.fromiter(at, np.int64, sizes.sum())
        owner = np.repeat(np.arange(len(texts)), sizes)
        # From words to their runs, from runs to their ids.
        owner = np.repeat(owner, each[at])
        runs = of[ranges((np.cumsum(each) - each)[at], each[at])]
        size = counts[runs]
        total = np.bincount(owner, size, len(texts)).astype(np.int64)
        return flat[ranges((np.cumsum(counts) - counts)[runs], size)], total

    def of(self, text: bytes) -> list[int]:
        return self.ids([text])[0].tolist()

    def printed(self, texts: list[bytes]) -> Iterator[tuple[list[int], str]]:
        """Per text its ids, and the text they decode to."""
        flat, total = self.ids(texts)
        ids, ends = flat.tolist(), np.cumsum(total).tolist()
        for low, high in zip([0, *ends], ends):
            own = ids[low:high]
            yield own, self.vocabulary.decode(own)


def blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts in runs of about ``BLOCK_BYTES``."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > BLOCK_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of runs that start at ``starts``, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts - before, sizes)


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _encoder(shared) -> WordIds:
    make = lambda: WordIds(Vocabulary(shared.value))
    return per_worker(("bpe", hash(shared.value)), make)


def encode(
    docs: DataFrame,
    vocabulary_path: str,
    *,
    text_col: str = "text",
    out: str = "ids",
    decoded: str | None = None,
) -> DataFrame:
    """``docs`` with a column of ids (array of int) at the end; NULL and "" give none.

    With ``decoded``, a column of that name with the text decoded from the ids comes behind it.
    Columns of these names are replaced; all others stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    rows = docs.drop(out, decoded) if decoded else docs.drop(out)
    schema = with_fields(rows.schema, f"`{out}` array<int>")
    if decoded:
        schema = with_fields(schema, f"`{decoded}` string")
    place = rows.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _encoder(shared)
        for batch in batches:
            at = 0
            for texts in blocks(utf8_texts(batch.column(place))):
                part = batch.slice(at, len(texts))
                at += len(texts)
                flat, sizes = words.ids(texts)
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))
                columns = [*part.columns, ids]
                if decoded:
                    own = map(np.ndarray.tolist, np.split(flat, ends[1:-1]))
                    columns.append(pa.array(map(words.vocabulary.decode, own), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(work, schema)


def decode(
    encoded: DataFrame, vocabulary_path: str, *, ids_col: str = "ids", out: str = "decoded"
) -> DataFrame:
    """``encoded`` with the decoded text at the end, special tokens included."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    rows = encoded.drop(out)
    schema = with_fields(rows.schema, f"`{out}` string")
    place = rows.columns.index(ids_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _encoder(shared).vocabulary
        for batch in batches:
            texts = [vocabulary.decode(ids or []) for ids in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out]
            )

    return rows.mapInArrow(work, schema)


def digests(
    docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``n_tokens`` and the SHA-256 of its ids and of their decoded text.

    Encodes and decodes in one pass, for checks where the ids themselves are not needed.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = with_fields(
        rows.select("id").schema, "n_tokens long, ids_sha256 string, decoded_sha256 string"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _encoder(shared)
        decimal = list(map(str, range(len(words.vocabulary.names)))).__getitem__
        sha256 = partial(hashlib.sha256, usedforsecurity=False)
        for batch in batches:
            sizes, of_ids, of_text = [], [], []
            for texts in blocks(utf8_texts(batch.column(1))):
                for ids, decoded in words.printed(texts):
                    sizes.append(len(ids))
                    of_ids.append(sha256(" ".join(map(decimal, ids)).encode()).hexdigest())
                    of_text.append(sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                schema.names,
            )

    return rows.mapInArrow(work, schema)
