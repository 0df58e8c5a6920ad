"""Language-model scores from a probabilistic suffix tree over words.

A text is a sequence of words and an end mark; every word that the training texts have is a symbol
of its own, and what was never seen shares one. The tree keeps a context of up to ``DEPTH`` words
if it comes ``LEAST_COUNT`` times and its next words diverge from those after its suffix, one word
shorter. A word is scored in the state of the longest suffix that the tree has; distributions are
smoothed with those of the shorter states, at last with add-one word frequencies.

The tree is never in one place. A chunk of documents sends each of its different words once to the
word's bucket, where the counts of all chunks meet, and gets back corpus-wide counts and numbers.
Then it sends its tokens to the bucket of the word before them, once for all depths: as all tokens
after that word meet there, its contexts of one and of two words are tested and the tokens scored
on the spot. What comes back are sums for each text; no run of words goes to and fro. Runs that
start with a word too frequent for one bucket are counted by their next word, along with the words;
its tokens are then dealt out by two words of context, and where these are too frequent as well, by
all three words: divergences are summed over the buckets, and texts have their sums for both
outcomes. No number of words, contexts or entries is bounded; chunks and buckets have about the
same size whatever the corpus. Words are counted as they are written and go by their numbers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyworks.llm.common import crc_remainder, pieces, utf8_texts, with_fields
from tallyworks.session import keep_table

END = 1
# Words of a context, at most: the order of the model, which the flow of data is made for. A third word changed the perplexity of
# held-out texts from 1,361 to 1,325 on sf0.1, and a fourth to 1,324.
DEPTH = 2
# A context is kept if it comes so often in the training texts, and if the divergence of its next
# words, summed over its occurrences, is at least so many bits.
LEAST_COUNT = 2
LEAST_DIVERGENCE = 20.0
# Weight of the shorter state's distribution after a context that comes n times, in occurrences:
# SMOOTHING * n ** GROWTH, as the different words after a context grow with a power of n.
SMOOTHING = 3.0
GROWTH = 0.75

# Text whose words are looked up together, and text for each bucket of counts.
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
# Contexts with more than this part of a bucket's share of all positions are spread; frequent words
# are seen in this part of the texts, or in so many bytes.
SPREAD_PART = 1 / 4
SAMPLE_PART = 1 / 100
SAMPLE_BYTES = 8 << 20

# The end mark among words, none of which has capitals.
END_WORD = b"END"
# Logarithms are summed as whole numbers, so many to the unit.
LOG_UNIT = 2.0**24
# Planes of bytes of so many rows are compressed one by one, as their bytes differ in kind.
PLANE_ROWS = 1024


def grams(texts: list[bytes]) -> np.ndarray:
    """For each symbol of a byte, the number of its DEPTH predecessors and itself, the newest lowest.

    What lies before a text reads as end marks.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    opens = np.cumsum(sizes) - sizes
    codes = np.zeros(len(data), np.uint32)
    for back in range(DEPTH, -1, -1):
        shifted = np.full(len(data), END, np.uint32)
        shifted[back:] = data[: len(data) - back]
        for step in range(back):
            at = opens[sizes > step] + step
            shifted[at] = END
        codes = (codes << np.uint32(8)) | shifted
    return codes


@dataclass
class Tree:
    """The tree of an alphabet of bytes in one process: a small, plain form to compare with.

    Kept contexts by length, each with its entries; numbers ascending for binary search.

    ``entries[d]`` are (context of d symbols, next symbol) codes with ``chances[d]``;
    ``contexts[d]`` with ``backoffs[d]``, the part of the shorter state where there is no entry.
    """

    entries: list[np.ndarray]
    chances: list[np.ndarray]
    contexts: list[np.ndarray]
    backoffs: list[np.ndarray]

    def probability(self, codes: np.ndarray, depth: int = DEPTH) -> np.ndarray:
        """Chance of each code's newest symbol in the longest kept state of at most ``depth``."""
        own = codes & np.uint32((1 << 8 * (depth + 1)) - 1)
        at = _find(self.entries[depth], own)
        result = np.where(at >= 0, self.chances[depth][at] if len(self.chances[depth]) else 0, 0.0)
        rest = np.flatnonzero(at < 0)
        if len(rest) and depth:
            shorter = self.probability(codes[rest], depth - 1)
            state = _find(self.contexts[depth], own[rest] >> np.uint32(8))
            if len(self.contexts[depth]):
                shorter *= np.where(state >= 0, self.backoffs[depth][state], 1.0)
            result[rest] = shorter
        return result


def _find(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Places of codes in an ascending table, -1 for those it lacks."""
    if not len(table):
        return np.full(len(codes), -1)
    at = np.minimum(np.searchsorted(table, codes), len(table) - 1)
    return np.where(table[at] == codes, at, -1)


def build(
    entries: list[np.ndarray], counts: list[np.ndarray], total: int, weight: float = 8.0
) -> Tree:
    """Divergence tests and smoothing over the entries of each depth, shortest first.

    Here the shorter state's distribution has a constant weight.
    """
    plain = np.full(256, 1 / 256)
    plain[entries[0].astype(np.int64)] += counts[0]
    tree = Tree(
        [np.arange(len(plain), dtype=np.uint32)],
        [plain / plain.sum()],
        [np.zeros(1, np.uint32)],
        [np.ones(1)],
    )
    for depth in range(1, DEPTH + 1):
        context, owner = np.unique(entries[depth] >> np.uint32(8), return_inverse=True)
        sums = np.bincount(owner, counts[depth], len(context))
        shorter = tree.probability(entries[depth], depth - 1)
        chance = (counts[depth] + weight * shorter) / (sums + weight)[owner]
        gain = counts[depth] * np.log2(chance / shorter)
        divergence = np.bincount(owner, gain, len(context))
        keep = (sums >= LEAST_COUNT) & (divergence >= LEAST_DIVERGENCE)
        mine = keep[owner]
        tree.entries.append(entries[depth][mine])
        tree.chances.append(chance[mine])
        tree.contexts.append(context[keep])
        tree.backoffs.append(weight / (sums[keep] + weight))
    return tree


@dataclass
class _Corpus:
    """What every chunk and bucket knows of the corpus."""

    buckets: int
    # Words after which runs are counted together with the words, END_WORD among them.
    frequent: dict[bytes, int]
    tokens: int = 0
    different: int = 0
    ends: int = 0
    # Of the frequent words: numbers, training counts, and whether they are kept as contexts.
    ids: np.ndarray | None = None
    sizes: np.ndarray | None = None
    kept: np.ndarray | None = None
    # Pairs of them that are too frequent a context for one bucket, ascending; their counts.
    hot: np.ndarray | None = None
    hot_sizes: np.ndarray | None = None

    def chances(self, counts: np.ndarray) -> np.ndarray:
        """Chances of words without a context; unseen ones share a part, by how often new ones came."""
        new = max(1, self.different)
        return np.where(counts > 0, counts, new) / (self.tokens + new)

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Places of words among the frequent ones, or -1."""
        order = np.argsort(self.ids)
        at = _find(self.ids[order], ids)
        return np.where(at >= 0, order[at], -1)

    def hot_pair(self, older: np.ndarray, newer: np.ndarray) -> np.ndarray:
        """Places of pairs of frequent words, given by their places, among the hot ones, or -1."""
        at = _find(self.hot, older * len(self.ids) + newer)
        return np.where((older >= 0) & (newer >= 0), at, -1)


class _Numbers(dict):
    """Numbers for keys, in the order in which they come."""

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        return number


def _smoothed(counts: np.ndarray, sizes: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Chances of words after a context that comes ``sizes`` times, from their counts there."""
    weight = SMOOTHING * sizes**GROWTH
    return (counts + weight * shorter) / (sizes + weight)


def _gains(counts: np.ndarray, longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Bits that the longer state saves over all occurrences of a word after a context."""
    return counts * np.log2(longer / shorter)


def _fixed(chances: np.ndarray) -> np.ndarray:
    """Minus log10 of chances as whole numbers, whose sums do not depend on any order."""
    return np.rint(np.log10(chances) * -LOG_UNIT).astype(np.int64)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left ^ (left >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + right
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(31))


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys ^ (keys >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


def _cuts(sorted_keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start, and the end."""
    if not len(sorted_keys):
        return np.zeros(1, np.int64)
    changes = np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1
    return np.concatenate(([0], changes, [len(sorted_keys)]))


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key the number of its group, ascending by key; and a place of each group."""
    order = np.argsort(keys)
    cuts = _cuts(keys[order])
    of = np.empty(len(keys), np.int64)
    of[order] = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    return of, order[cuts[:-1]]


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers from 0 on as planes of their bytes, compressed."""
    head, blocks, rest = [], [], []
    for column in columns:
        column = np.ascontiguousarray(column, "<i8")
        width = (int(column.max(initial=0)).bit_length() + 7) // 8
        planes = column.view(np.uint8).reshape(-1, 8)[:, :width].T
        if len(column) < PLANE_ROWS:
            rest.append(planes.tobytes())
        else:
            blocks += [plane.tobytes() for plane in planes]
        head += [len(column), width]
    blocks.append(b"".join(rest))
    packed = [pa.compress(block, codec="zstd", asbytes=True) if block else b"" for block in blocks]
    head = [len(columns), *head, *map(len, packed)]
    return np.array(head, "<i8").tobytes() + b"".join(packed)


def _unpack(data: bytes) -> list[np.ndarray]:
    count = int(np.frombuffer(data, "<i8", 1)[0])
    head = np.frombuffer(data, "<i8", 2 * count, 8).reshape(-1, 2).tolist()
    sizes = [n for n, width in head if n >= PLANE_ROWS for _ in range(width)]
    sizes.append(sum(n * width for n, width in head if n < PLANE_ROWS))
    at = 8 + 16 * count
    lengths = np.frombuffer(data, "<i8", len(sizes), at).tolist()
    at += 8 * len(sizes)
    blocks = []
    for size, length in zip(sizes, lengths):
        block = data[at : at + length]
        block = pa.decompress(block, size, codec="zstd", asbytes=True) if size else b""
        blocks.append(np.frombuffer(block, np.uint8))
        at += length
    found, rest, block = [], 0, 0
    for n, width in head:
        column = np.zeros((n, 8), np.uint8)
        for byte in range(width):
            if n < PLANE_ROWS:
                column[:, byte] = blocks[-1][rest : rest + n]
                rest += n
            else:
                column[:, byte] = blocks[block]
                block += 1
        found.append(column.reshape(-1).view("<i8"))
    return found


def _unpacked(rows: pa.ChunkedArray) -> list[np.ndarray]:
    """The columns of all rows, one after the other."""
    return [np.concatenate(parts) for parts in zip(*map(_unpack, rows.to_pylist()))]


class _Chunk:
    """The tokens of some texts, by the place of their word among the different ones.

    Words stand by bucket, and in it in an order that the texts' order does not change.
    """

    def __init__(self, texts: list[bytes], trains: np.ndarray, corpus: _Corpus) -> None:
        self.corpus = corpus
        numbers = _Numbers()
        end = numbers[END_WORD]
        found, sizes = [], np.ones(len(texts), np.int64)
        for at, text in enumerate(texts):
            for piece in pieces(text):
                words = piece.lower().split()
                found.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                sizes[at] += len(words)
            found.append(np.full(1, end, np.int32))
        words = list(numbers)
        hashes = pd.util.hash_array(np.array(words, object), categorize=False)
        bucket = _bucket_of(hashes, corpus.buckets)
        places = np.lexsort((hashes, bucket))
        if (np.diff(hashes[places].view(np.int64)) == 0).any():
            places = np.array(sorted(range(len(words)), key=lambda at: (bucket[at], words[at])))
        self.words = [words[at] for at in places.tolist()]
        self.hashes, self.bucket = hashes[places], bucket[places]
        rank = np.empty(len(words), np.int32)
        rank[places] = np.arange(len(words))
        self.at, self.end = rank[np.concatenate(found)], int(rank[end])
        self.sizes = sizes
        self.starts = np.cumsum(sizes) - sizes
        self.trains = np.repeat(trains, sizes)
        self.newer = self._before(self.at)
        # The runs of a frequent word and the next one, by the next one: which tokens have one,
        # and the number of its run.
        place = corpus.frequent
        self.place = np.fromiter((place.get(word, -1) for word in self.words), np.int64, len(words))
        after = self.place[self.newer]
        self.followers = np.flatnonzero(after >= 0)
        keys = self.at[self.followers].astype(np.int64) * len(place) + after[self.followers]
        self.pair_of, first = _grouped(keys)
        self.pairs = keys[first]

    def _before(self, values: np.ndarray) -> np.ndarray:
        """For each token the word before it; what lies before a text reads as end marks."""
        result = np.empty_like(values)
        result[1:] = values[:-1]
        result[self.starts] = self.end
        return result

    def word_rows(self) -> Iterator[tuple[int, bytes, bytes]]:
        """Bucket, words, and how often they and their runs come in the training texts here."""
        own = np.bincount(self.at[self.trains], minlength=len(self.words))
        runs = np.bincount(self.pair_of, self.trains[self.followers], len(self.pairs))
        owner, after = np.divmod(self.pairs, len(self.corpus.frequent))
        by_word = np.bincount(owner, minlength=len(self.words))
        cuts = _cuts(self.bucket)
        of_runs = np.concatenate(([0], np.cumsum(by_word)))[cuts].tolist()
        for at, (low, high) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            mine = slice(of_runs[at], of_runs[at + 1])
            body = _pack(own[low:high], by_word[low:high], after[mine], runs[mine])
            yield int(self.bucket[low]), b" ".join(self.words[low:high]), body

    def learn(self, answers: pa.Table) -> None:
        """Take the words' numbers and counts, and the counts of the runs."""
        columns = _unpacked(answers.sort_by("bucket")["body"])
        if [len(column) for column in columns] != [len(self.words)] * 2 + [len(self.pairs)]:
            raise RuntimeError("the documents came in another order when they were read again")
        self.ids, self.counts, self.pair_counts = columns

    def scores(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By text: known tokens, the base score, and the score of tokens that have no state."""
        corpus = self.corpus
        # The end mark is a token of its own kind; what was never seen is another.
        kinds = corpus.different + (1 if corpus.ends else 0) + 1
        base = np.log10((self.counts + 1) / (corpus.tokens + 1 * kinds))
        alone = np.where(self._stateless(), _fixed(corpus.chances(self.counts))[self.at], 0)
        return (
            np.add.reduceat((self.counts > 0)[self.at].astype(np.int64), self.starts),
            np.add.reduceat(base[self.at], self.starts),
            np.add.reduceat(alone, self.starts),
        )

    def _stateless(self) -> np.ndarray:
        return self.counts[self.newer] < LEAST_COUNT

    def token_rows(self) -> Iterator[tuple[int, bytes]]:
        """Bucket, and its tokens by the word before them and their own.

        The bucket is that of the word before; after a frequent word, whose runs are counted,
        that of the two words before; and if these are too frequent too, that of all three.
        """
        corpus, buckets = self.corpus, self.corpus.buckets
        asks = np.flatnonzero(~self._stateless())
        word, newer, older = self.at[asks], self.newer[asks], self._before(self.newer)[asks]
        bucket, place = self.bucket[newer], self.place[newer]
        often = np.flatnonzero(place >= 0)
        pair = _mixed(self.hashes[older[often]], self.hashes[newer[often]])
        hot = corpus.hot_pair(self.place[older[often]], place[often]) >= 0
        pair[hot] = _mixed(pair[hot], self.hashes[word[often[hot]]])
        bucket[often] = _bucket_of(pair, buckets)
        paired = np.zeros(len(self.at), np.int64)
        paired[self.followers] = self.pair_counts[self.pair_of]
        text = np.repeat(np.arange(len(self.sizes)) << 1, self.sizes) | self.trains

        many = len(self.words)
        keys = (bucket * many + newer) * many + word
        order = np.argsort(keys)
        heads = _cuts(keys[order] // many)
        runs = _cuts(keys[order])
        asks, older = asks[order], self.ids[older[order]]
        lead = asks[runs[:-1]]
        columns = (self.ids[self.at[lead]], self.counts[self.at[lead]], paired[lead], np.diff(runs))
        text, context = text[asks], self.ids[self.newer[asks[heads[:-1]]]]
        of_heads = _cuts(bucket[order[heads[:-1]]])
        of_tokens = heads[of_heads]
        first_run = np.searchsorted(runs, heads)
        of_runs, length = first_run[of_heads], np.diff(first_run)
        for at in range(len(of_heads) - 1):
            mine = slice(of_heads[at], of_heads[at + 1])
            theirs = slice(of_runs[at], of_runs[at + 1])
            tokens = slice(of_tokens[at], of_tokens[at + 1])
            body = _pack(
                context[mine], length[mine], *(column[theirs] for column in columns),
                older[tokens], text[tokens],
            )
            yield int(bucket[order[of_tokens[at]]]), body


_COUNTED = "chunk long, bucket long, body binary, different long, tokens long, marks binary, after binary"
_ASKED = "chunk long, bucket long, body binary, texts binary"
_ANSWERED = "chunk long, bucket long, body binary, texts binary, hot binary"


def _table(columns: list, schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(",")]
    columns = columns or [[]] * len(fields)
    arrays = [pa.array(column, kinds[kind]) for column, (_, kind) in zip(columns, fields)]
    return pa.table(arrays, names=[name for name, _ in fields])


def _split(values: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    return np.split(values, np.cumsum(sizes)[:-1])


def _ipc(table: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, table.schema, options=options) as stream:
        stream.write(table)
    return sink.getvalue().to_pybytes()


def _from_ipc(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Each batch of ``id``, ``trains``, ``text`` with its rows' chunks, whatever the batches."""
    chunk, held = TaskContext.get().partitionId() << 33, 0
    for batch in batches:
        numbers = []
        for size in pc.binary_length(batch.column(2)).fill_null(0).to_pylist():
            if held and held + size > CHUNK_BYTES:
                chunk, held = chunk + 1, 0
            # Empty texts take room too.
            held += size + 8
            numbers.append(chunk)
        yield batch, numbers


def _chunked(rows: DataFrame) -> DataFrame:
    """Rows by the number of their chunk, many in one: neighbours in the scan share a chunk."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, numbers in _numbered(batches):
            cuts = _cuts(np.array(numbers)).tolist()
            for low, high in zip(cuts[:-1], cuts[1:]):
                columns = [[numbers[low]], [_ipc(batch.slice(low, high - low))]]
                yield from _table(columns, schema).to_batches()

    schema = "chunk long, texts binary"
    return rows.mapInArrow(work, schema)


def _frequent_words(rows: DataFrame, size: int, buckets: int) -> dict[bytes, int]:
    """Words that seem to make up much of a bucket, and the end mark, with their places.

    Seen in some of the texts: which words they are changes where runs are counted, no count.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for text in utf8_texts(batch.column(2)):
                for piece in pieces(text):
                    counts.update(piece.lower().split())
        columns = [list(counts), list(counts.values())]
        yield from _table(columns, schema).to_batches(max_chunksize=100_000)

    schema = "word binary, n long"
    part = max(SAMPLE_PART, min(1.0, SAMPLE_BYTES / max(1, size)))
    some = rows.sample(part, seed=5) if part < 1 else rows
    summed = keep_table(some.mapInArrow(work, schema).groupBy("word").agg(F.sum("n").alias("n")))
    total = summed.agg(F.sum("n")).first()[0] or 0
    found = summed.where(F.col("n") * buckets > total * SPREAD_PART).select("word").collect()
    return {word: at for at, word in enumerate([END_WORD, *sorted(bytes(r.word) for r in found)])}


def _count_words(rows: DataFrame, corpus: _Corpus) -> DataFrame:
    """For each chunk's words their numbers and training counts, and counts after frequent words.

    ``different`` and ``tokens`` are sums of a bucket, ``marks`` its frequent words with number and
    count, ``after`` its runs: place of the frequent word, count, count of the next word alone,
    and its place, from 1 on, if that is frequent too.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, texts, trains = None, [], []

        def settle() -> Iterator[pa.RecordBatch]:
            found = list(_Chunk(texts, np.array(trains, bool), corpus).word_rows())
            table = _table([[now] * len(found), *zip(*found)], schema)
            yield from table.to_batches(max_chunksize=64)

        for batch, numbers in _numbered(batches):
            own = zip(numbers, batch.column(1).to_pylist(), utf8_texts(batch.column(2)))
            for number, train, text in own:
                if number != now:
                    if texts:
                        yield from settle()
                    now, texts, trains = number, [], []
                texts.append(text)
                trains.append(train)
        if texts:
            yield from settle()

    def answer(asked: pa.Table) -> pa.Table:
        numbers, bucket = _Numbers(), asked["bucket"][0].as_py()
        at = []
        for words in asked["words"].to_pylist():
            words = words.split()
            at.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        rows = [_unpack(body) for body in asked["body"].to_pylist()]
        own, by_word, after, runs = map(np.concatenate, zip(*rows))
        flat = np.concatenate(at)
        counts = np.bincount(flat, own, len(numbers)).astype(np.int64)
        of, first = _grouped(np.repeat(flat, by_word) * len(corpus.frequent) + after)
        run_counts = np.bincount(of, runs, len(first)).astype(np.int64)
        # Frequent words have small numbers.
        ids = np.empty(len(counts), np.int64)
        ids[np.argsort(-counts, kind="stable")] = np.arange(len(counts)) * corpus.buckets + bucket
        place = np.fromiter((corpus.frequent.get(word, -1) for word in numbers), np.int64)
        marks = np.flatnonzero(place >= 0)
        next_word, sizes = np.repeat(flat, by_word)[first], list(map(len, at))
        seen = run_counts > 0
        parts = zip(
            _split(ids[flat], sizes), _split(counts[flat], sizes),
            _split(run_counts[of], [len(row[2]) for row in rows]),
        )
        rest = [None] * (len(sizes) - 1)
        return _table(
            [
                asked["chunk"].to_pylist(),
                asked["bucket"].to_pylist(),
                [_pack(*part) for part in parts],
                [int(np.count_nonzero(counts)), *rest],
                [int(counts.sum()), *rest],
                [_pack(place[marks], ids[marks], counts[marks]), *rest],
                [
                    _pack(
                        after[first][seen], run_counts[seen], counts[next_word][seen],
                        place[next_word][seen] + 1,
                    ),
                    *rest,
                ],
            ],
            _COUNTED,
        )

    schema = "chunk long, bucket long, words binary, body binary"
    return rows.mapInArrow(ask, schema).groupBy("bucket").applyInArrow(answer, _COUNTED)


def _with_frequent(corpus: _Corpus, counted: DataFrame) -> _Corpus:
    """The corpus with what is known after the words are counted; a few numbers of each bucket."""
    different, tokens = counted.agg(F.sum("different"), F.sum("tokens")).first()
    many = len(corpus.frequent)
    ids, sizes = np.full(many, -1, np.int64), np.zeros(many, np.int64)
    for row in counted.where("marks IS NOT NULL").select("marks").collect():
        place, number, count = _unpack(bytes(row.marks))
        ids[place], sizes[place] = number, count
    ends = int(sizes[0])
    corpus = replace(
        corpus, tokens=tokens or 0, different=(different or 0) - (ends > 0), ends=ends,
        ids=ids, sizes=sizes,
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = np.zeros(many)
        for batch in batches:
            for after in batch.column(0).to_pylist():
                place, count, alone, following = _unpack(after)
                shorter = corpus.chances(alone)
                longer = _smoothed(count, corpus.sizes[place], shorter)
                gains += np.bincount(place, _gains(count, longer, shorter), many)
                hot = (following > 0) & (count * corpus.buckets > corpus.tokens * SPREAD_PART)
                columns = [place[hot], following[hot] - 1, count[hot].astype(float)]
                yield from _table(columns, schema).to_batches()
        some = np.flatnonzero(gains)
        yield from _table([some, np.full(len(some), -1), gains[some]], schema).to_batches()

    schema = "older long, newer long, value double"
    parts = counted.where("after IS NOT NULL").select("after").mapInArrow(work, schema)
    found = parts.groupBy("older", "newer").agg(F.sum("value").alias("value")).collect()
    gains = np.zeros(many)
    pairs = {}
    for row in found:
        if row.newer < 0:
            gains[row.older] = row.value
        else:
            pairs[row.older * many + row.newer] = int(row.value)
    return replace(
        corpus,
        kept=(sizes >= LEAST_COUNT) & (gains >= LEAST_DIVERGENCE),
        hot=np.array(sorted(pairs), np.int64),
        hot_sizes=np.array([pairs[key] for key in sorted(pairs)], np.int64),
    )


def _count_runs(rows: DataFrame, counted: DataFrame, shared) -> DataFrame:
    """The scores of each chunk's texts, in the parts that the buckets have of them.

    ``body`` has texts and what their tokens after contexts of the bucket come to; then hot
    contexts, texts, and what those tokens come to if the context is kept, and if it is not.
    ``hot`` has the bucket's part of the hot contexts' gains. One row of a chunk has its ``texts``.
    """

    def ask(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(texts):
            return _table([], _ASKED)
        number = texts["chunk"][0].as_py()
        texts = pa.concat_tables([_from_ipc(part) for part in texts["texts"].to_pylist()])
        trains = texts["trains"].combine_chunks().to_numpy(zero_copy_only=False)
        corpus = _Corpus(**shared.value)
        chunk = _Chunk(utf8_texts(texts["text"]), trains.astype(bool), corpus)
        chunk.learn(answers)
        known, base, alone = chunk.scores()
        texts = texts.select(["id", "trains"])
        for name, column in (("n", chunk.sizes), ("known", known), ("base", base), ("alone", alone)):
            texts = texts.append_column(name, pa.array(column))
        found = [(number, bucket, body, None) for bucket, body in chunk.token_rows()]
        # This goes along with any of the buckets.
        bucket = _bucket_of(np.array([number], np.uint64), corpus.buckets)
        found.append((number, int(bucket[0]), None, _ipc(texts)))
        return _table(list(zip(*found)), _ASKED)

    def answer(asked: pa.Table) -> pa.Table:
        passes = pc.is_valid(asked["texts"])
        texts, asked = asked.filter(passes), asked.filter(pc.invert(passes))
        texts = texts.append_column("hot", pa.nulls(len(texts), pa.binary()))
        if not len(asked):
            return texts
        corpus = _Corpus(**shared.value)
        rows = [_unpack(body) for body in asked["body"].to_pylist()]
        sizes = [len(row[-1]) for row in rows]
        newer, runs, word, count, paired, tokens, older, text = map(np.concatenate, zip(*rows))
        del rows
        trains, text = text & 1, text >> 1

        # Runs of two. There are less than 2 ** 40 words.
        head, some = _grouped(newer)
        newer = newer[some]
        head = np.repeat(head, runs)
        of, some = _grouped(head << 40 | word)
        run = of[np.repeat(np.arange(len(of)), tokens)]
        head, shorter = head[some], corpus.chances(count[some])
        place = corpus.places(newer)
        often = place >= 0
        counts = np.where(often[head], paired[some], np.bincount(run, trains, len(some)))
        size = np.where(often, corpus.sizes[place], np.bincount(head, counts, len(newer)))
        longer = _smoothed(counts, size[head], shorter)
        gains = np.bincount(head, _gains(counts, longer, shorter), len(newer))
        kept = (size >= LEAST_COUNT) & (gains >= LEAST_DIVERGENCE)
        kept = np.where(often, corpus.kept[place], kept)
        chance = np.where(kept[head], longer, shorter)

        # Runs of three.
        context, some = _grouped(head[run] << 40 | older)
        hot = corpus.hot_pair(corpus.places(older[some]), place[head[run[some]]])
        size = np.bincount(context, trains, len(some))
        if len(corpus.hot):
            size = np.where(hot >= 0, corpus.hot_sizes[hot], size)
        of, some = _grouped(context * len(chance) + run)
        owner, shorter = context[some], chance[run[some]]
        counts = np.bincount(of, trains, len(some))
        longer = _smoothed(counts, np.maximum(size, 1)[owner], shorter)
        gains = np.bincount(owner, _gains(counts, longer, shorter), len(size))
        kept = (size >= LEAST_COUNT) & (gains >= LEAST_DIVERGENCE)
        is_hot, hot_of = (hot >= 0)[context], hot[context]
        longer, shorter = _fixed(longer), _fixed(shorter)
        value = np.where(kept[owner], longer, shorter)[of]

        bodies, high = [], 0
        for size in sizes:
            low, high = high, high + size
            mine, apart = text[low:high], is_hot[low:high]
            plain = mine[~apart]
            sums = np.bincount(plain, value[low:high][~apart])
            at = np.flatnonzero(np.bincount(plain))
            key = (hot_of[low:high][apart] << 32) | mine[apart]
            own, some = _grouped(key)
            both = [np.bincount(own, v[of[low:high][apart]], len(some)) for v in (longer, shorter)]
            bodies.append(_pack(at, sums[at], key[some] >> 32, key[some] & 0xFFFFFFFF, *both))
        some = np.flatnonzero(hot >= 0)
        part = np.array([hot[some], gains[some].view(np.int64)], "<i8").tobytes()
        found = _table(
            [
                asked["chunk"].to_pylist(),
                asked["bucket"].to_pylist(),
                bodies,
                [None] * len(sizes),
                [part if len(some) else None] + [None] * (len(sizes) - 1),
            ],
            _ANSWERED,
        )
        return pa.concat_tables([found, texts])

    pairs = _chunked(rows).groupBy("chunk").cogroup(counted.groupBy("chunk"))
    return pairs.applyInArrow(ask, _ASKED).groupBy("bucket").applyInArrow(answer, _ANSWERED)


def _kept_hot(corpus: _Corpus, answers: DataFrame) -> np.ndarray:
    """Whether hot contexts are kept: a few for each bucket, whatever the corpus."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column(0).to_pylist():
                hot, gains = np.frombuffer(part, "<i8").reshape(2, -1)
                yield from _table([hot, gains.view(np.float64)], schema).to_batches()

    schema = "hot long, gain double"
    parts = answers.where("hot IS NOT NULL").select("hot").mapInArrow(listed, schema)
    summed = parts.groupBy("hot").agg(F.sum("gain").alias("gain"))
    kept = np.zeros(len(corpus.hot), bool)
    for row in summed.where(F.col("gain") >= LEAST_DIVERGENCE).collect():
        kept[row.hot] = corpus.hot_sizes[row.hot] >= LEAST_COUNT
    return kept


def _settled(answers: DataFrame) -> DataFrame:
    """The answers as a table; what was shuffled for them, the texts too, goes when it is written."""
    conf, name = answers.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        return keep_table(answers)
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def score(
    docs: DataFrame, trains: Column, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``trains``, counts of its tokens, and its scores.

    Tokens are words (runs of anything but ASCII white space, A-Z lower-cased) and one end mark.
    ``n_tokens``; ``n_known``: tokens that the training texts have; ``train_tokens``: N, all
    training tokens; ``base_score``: the add-one unigram log10 probability; ``score``: that of
    the suffix tree, of the whole text. Training texts are the rows for which ``trains`` is true.
    NULL and empty texts are a single end mark. Rows that repeat count each time. Words count as
    one kind of token where they are unknown, in both scores. ``docs`` must give its rows in the
    same order whenever it is computed, as a scan of files does; else the job fails.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(trains, F.lit(False)).alias("trains"),
        F.col(text_col).alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(size / BUCKET_BYTES))
    corpus = _Corpus(buckets, _frequent_words(rows, size, buckets))
    counted = _settled(_count_words(rows, corpus))
    corpus = _with_frequent(corpus, counted)
    context = docs.sparkSession.sparkContext
    counted = counted.select("chunk", "bucket", "body")
    # Its fields: a broadcast value's class would have to be installed on the executors.
    shared = context.broadcast(vars(corpus))
    answers = _settled(_count_runs(rows, counted, shared))
    tokens, kept = corpus.tokens, context.broadcast(_kept_hot(corpus, answers))
    schema = with_fields(
        rows.select("id", "trains").schema,
        "n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )

    def work(answers: pa.Table) -> pa.Table:
        (texts,) = (part for part in answers["texts"].to_pylist() if part is not None)
        texts = _from_ipc(texts)
        total = texts["alone"].to_numpy().copy()
        for body in answers["body"].to_pylist():
            if body is None:
                continue
            at, sums, hot, hot_at, longer, shorter = _unpack(body)
            total[at] += sums
            if len(hot):
                np.add.at(total, hot_at, np.where(kept.value[hot], longer, shorter))
        columns = [
            texts["id"],
            texts["trains"],
            texts["n"],
            texts["known"],
            pa.array(np.full(len(texts), tokens, np.int64)),
            texts["base"],
            pa.array(total / -LOG_UNIT),
        ]
        return pa.table(columns, names=schema.names)

    parts = answers.select("chunk", "body", "texts")
    return parts.groupBy("chunk").applyInArrow(work, schema)


def held_out(key: Column) -> Column:
    """The seventh of the documents that nothing is learned from."""
    return crc_remainder(key, 7) == 2
