"""Repeated byte strings, found by a hash-compared suffix sort.

Two suffixes are compared by the length of their common beginning, which a binary search over
prefix polynomial hashes finds in a logarithmic number of steps; a mergesort over that comparison
brings equal strings together, and the bytes of neighbours are compared before they count as
equal.

To sort in parts, every window of ``length`` bytes is sent to the place of its *anchor*: of the
``CORE``-byte strings in it, the one with the smallest hash (the leftmost of equals). Equal
windows have equal anchors at equal distances, so only suffixes of one anchor are ever compared.
Neighbouring windows mostly share their anchor and travel as one *context*.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import with_fields
from tallyworks.session import keep_table

CORE = 64
# Different contexts of one anchor that one sort may get. Windows of anchors with more are counted
# by their SHA-256, which no frequent anchor can bring into one task: first so many at a time,
# then one by one where those do not repeat as a whole.
SORTED_TOGETHER = 2048
COUNTED_TOGETHER = 16

# Bytes hashed at once, and bytes of contexts sorted at once.
_STEP = 1 << 20
_BLOCK = 1 << 20
# Runs of windows cut before their pieces are passed on.
_RUNS_AT_ONCE = 64
_PLACE_BITS = 24


class Polynomial:
    """Hashes of substrings as differences of prefix sums, modulo 2^64.

    A string c0 c1 c2 ... has the hash r(c0) + r(c1) b + r(c2) b^2 + ..., with a random number
    r for each byte and an odd base b, whose powers can be divided out again.
    """

    def __init__(self, seed: int, size: int) -> None:
        draw = np.random.default_rng(seed)
        self.values = draw.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(draw.integers(1 << 40, 1 << 62)) | 5
        self.powers = self._powers(base, size)
        self.inverses = self._powers(pow(base, -1, 1 << 64), size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        return np.multiply.accumulate(powers)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.inverses[start]


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(32))


def _least_in_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours: of the rest of a block and the next one's head."""
    count = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    heads = np.minimum.accumulate(blocks, axis=1).ravel()
    rests = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(rests[:count], heads[width - 1 : width - 1 + count])


class Anchors:
    """Finds the contexts of a buffer of texts laid end to end."""

    def __init__(self, length: int) -> None:
        if not CORE < length < CORE + 255:
            raise ValueError(f"length must be from {CORE + 1} to {CORE + 254}")
        self.length = length
        self.width = length - CORE + 1
        self.first = Polynomial(1, _STEP + 2 * length)
        self.second = Polynomial(2, _STEP + 2 * length)

    def contexts(self, data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Anchor hash, context hash, first window, last window, anchor; places in ``data``.

        ``ends`` are the ends of the texts, ascending. A context is never cut by a step.
        """
        at = 0
        while at + self.length <= len(data):
            part = data[at : at + _STEP + self.length - 1]
            windows = len(part) - self.length + 1
            more = at + len(part) < len(data)
            inside = ends[np.searchsorted(ends, at, "right") :] - at
            inside = inside[inside < windows + self.length]
            blocked = np.zeros(windows + 1, np.int64)
            np.add.at(blocked, np.clip(inside - self.length + 1, 0, windows), 1)
            np.add.at(blocked, np.clip(inside, 0, windows), -1)
            free = np.cumsum(blocked[:-1]) == 0

            sums = self.first.prefixes(part)
            cores = len(part) - CORE + 1
            hashes = (sums[CORE:] - sums[:cores]) * self.first.inverses[:cores]
            hashes = _mixed(hashes)
            mask = np.uint64((1 << _PLACE_BITS) - 1)
            keys = (hashes & ~mask) | np.arange(cores, dtype=np.uint64)
            anchors = (_least_in_windows(keys, self.width) & mask).astype(np.int64)

            changes = np.empty(windows, bool)
            changes[0] = True
            changes[1:] = (anchors[1:] != anchors[:-1]) | (free[1:] != free[:-1])
            first = np.flatnonzero(changes)
            last = np.append(first[1:], windows) - 1
            step = windows
            if more and free[first[-1]] and first[-1]:
                step = int(first[-1])
                first, last = first[:-1], last[:-1]
            real = free[first]
            first, last = first[real], last[real]
            if len(first):
                anchor = anchors[first]
                other = self.second.prefixes(part)
                content = self.second.between(other, first, last + self.length)
                shape = ((anchor - first) << 8 | (last - first)).astype(np.uint64)
                yield (
                    hashes[anchor],
                    _mixed(content + _mixed(shape + np.uint64(1))),
                    first + at,
                    last + at,
                    anchor + at,
                )
            at += step


def _anchor_rows(rows: DataFrame, length: int) -> DataFrame:
    """``row``, ``anchor``, ``context``, ``place``: a row per context of each text.

    ``place`` packs the first window's start, the number of windows less one, and the distance
    of the anchor from the first start.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length)
        names = ["row", "anchor", "context", "place"]
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            numbers = batch.column(0).to_numpy()
            _, offsets, data = texts.buffers()
            bounds = np.frombuffer(offsets, np.int64)[texts.offset :][: len(texts) + 1]
            content = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
            content = content[bounds[0] : bounds[-1]]
            bounds = bounds - bounds[0]
            for anchor, context, first, last, core in finder.contexts(content, bounds[1:]):
                owner = np.searchsorted(bounds, first, "right") - 1
                place = (first - bounds[owner]) << 16 | (last - first) << 8 | (core - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers[owner]),
                        pa.array(anchor.view(np.int64)),
                        pa.array(context.view(np.int64)),
                        pa.array(place),
                    ],
                    names,
                )

    return rows.select("row", "text").mapInArrow(
        work, "row long, anchor long, context long, place long"
    )


def _merge_sorted(order: np.ndarray, group: np.ndarray, longer, less_byte) -> np.ndarray:
    """Mergesort of suffixes within groups, all groups at once.

    ``order`` lists suffixes group by group; ``group`` is the group of each place in it.
    ``longer(a, b)`` gives the common lengths of suffixes, ``less_byte(a, b, at)`` says whether
    a's byte after it is smaller. A merge finds the rank of each suffix in its partner run.
    """
    count = len(order)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(starts, count))
    begin = np.repeat(starts, sizes)
    size = np.repeat(sizes, sizes)
    inside = np.arange(count) - begin
    run = 1
    while run < sizes.max(initial=0):
        mine = inside // run
        partner = mine ^ 1
        low = np.minimum(partner * run, size)
        high = np.minimum(low + run, size)
        moving = np.flatnonzero(low < high)
        bottom, top = low[moving].copy(), high[moving].copy()
        # Of equals, the left run goes first.
        left = mine[moving] % 2 == 0
        while (live := np.flatnonzero(bottom < top)).size:
            middle = (bottom[live] + top[live]) // 2
            a = order[moving[live]]
            b = order[begin[moving[live]] + middle]
            common, most = longer(a, b)
            equal = common >= most
            b_first = np.where(equal, ~left[live], less_byte(b, a, np.minimum(common, most - 1)))
            bottom[live] = np.where(b_first, middle + 1, bottom[live])
            top[live] = np.where(b_first, top[live], middle)
        place = begin + inside
        pair = np.minimum(mine, partner) * run
        own = inside[moving] - mine[moving] * run
        place[moving] = begin[moving] + pair[moving] + own + bottom - low[moving]
        merged = np.empty_like(order)
        merged[place] = order
        order = merged
        run *= 2
    return order


def repeated_windows(
    data: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int, hashes: Polynomial
) -> np.ndarray:
    """Which windows (their starts in ``data``) have an equal one in their group.

    ``group`` must be ascending.
    """
    sums = hashes.prefixes(data)

    def longer(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, int]:
        low, high = np.zeros(len(a), np.int64), np.full(len(a), length, np.int64)
        x, y = starts[a], starts[b]
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = hashes.between(sums, x, x + middle) == hashes.between(sums, y, y + middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        return low, length

    def less_byte(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        return data[starts[a] + at] < data[starts[b] + at]

    order = _merge_sorted(np.arange(len(starts)), group, longer, less_byte)
    a, b = order[:-1], order[1:]
    x, y = starts[a], starts[b]
    near = (group[a] == group[b]) & (
        hashes.between(sums, x, x + length) == hashes.between(sums, y, y + length)
    )
    # Collision check: equal hashes must mean equal bytes.
    texts = np.lib.stride_tricks.sliding_window_view(data, length)
    refuted: set[int] = set()
    for part in np.array_split(np.flatnonzero(near), max(1, len(starts) >> 14)):
        wrong = (texts[x[part]] != texts[y[part]]).any(axis=1)
        refuted.update(group[a[part[wrong]]].tolist())
    found = np.zeros(len(starts), bool)
    found[a[near]] = True
    found[b[near]] = True
    for number in refuted:  # such a group is compared by its bytes
        members = np.flatnonzero(group == number)
        whole = [texts[starts[member]].tobytes() for member in members]
        counts = Counter(whole)
        found[members] = [counts[text] > 1 for text in whole]
    return found


def _sorted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """Spans ``row``, ``low``, ``high`` of repeated windows in single contexts.

    ``contexts``: ``anchor``, ``row``, ``place``, ``single``, ``content``. All contexts of an
    anchor meet in one task, at most ``SORTED_TOGETHER`` of them.
    """

    def sort(table: pa.Table) -> pa.RecordBatch:
        place = table.column("place").to_numpy()
        count, core = (place >> 8 & 0xFF) + 1, place & 0xFF
        texts = table.column("content").combine_chunks().cast(pa.large_binary())
        _, offsets, buffer = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset :][: len(texts) + 1]
        data = np.frombuffer(buffer, np.uint8)[bounds[0] : bounds[-1]]
        owner = np.repeat(np.arange(len(place)), count)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        start = (bounds[:-1] - bounds[0])[owner] + step
        # Windows can be equal only at the same distance from equal anchors.
        anchor = np.unique(table.column("anchor").to_numpy(), return_inverse=True)[1][owner]
        key = anchor * 256 + (core[owner] - step + 128)
        by_group = np.argsort(key, kind="stable")
        found = np.empty(len(owner), bool)
        found[by_group] = repeated_windows(
            data, start[by_group], key[by_group], length, Polynomial(3, len(data) + 1)
        )
        found &= table.column("single").to_numpy(zero_copy_only=False)[owner]
        # Neighbouring windows make one span.
        hits = np.flatnonzero(found)
        opens = np.append(True, (np.diff(hits) != 1) | (np.diff(owner[hits]) != 0))[: len(hits)]
        low = hits[opens]
        high = hits[np.append(opens[1:], True)[: len(hits)]]
        base = (place >> 16)[owner[low]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(table.column("row").to_numpy()[owner[low]]),
                pa.array(base + step[low]),
                pa.array(base + step[high] + length),
            ],
            ["row", "low", "high"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < _BLOCK:
                continue
            table = pa.Table.from_batches(held)
            anchors = table.column("anchor").to_numpy()
            # The last anchor may go on in the next batch.
            cut = int(np.searchsorted(anchors, anchors[-1], "left"))
            if cut:
                yield sort(table.slice(0, cut))
                table = table.slice(cut)
            held = table.to_batches()
            size = sum(part.nbytes for part in held) if cut else 0
        if held:
            yield sort(pa.Table.from_batches(held))

    grouped = contexts.select("anchor", "row", "place", "single", "content")
    grouped = grouped.repartition("anchor").sortWithinPartitions("anchor")
    return grouped.mapInArrow(work, "row long, low long, high long")


def _pieces(runs: DataFrame, length: int, together: int) -> DataFrame:
    """Runs of windows cut into pieces of at most ``together``, each with its bytes' SHA-256.

    ``runs`` and the result: ``row``, ``low`` (first window), ``windows``, ``core`` (from there to
    the anchor), ``single``, ``content``; single windows come without their bytes. Cuts are at
    multiples of ``together`` from the anchor, so that equal runs of different contexts line up.
    ``inner`` is the digest of the bytes that all windows between two cuts would share: windows
    can be equal only in pieces whose ``inner`` is.
    """
    names = ["row", "low", "windows", "core", "single", "content", "digest", "inner"]
    schema = (
        "row long, low long, windows long, core long, single boolean, "
        "content binary, digest binary, inner binary"
    )
    types = [pa.int64()] * 4 + [pa.bool_()] + [pa.binary()] * 3

    def cut(row, low, windows, core, single, content):
        at = 0
        while at < windows:
            width = min((core - at) % together + 1, windows - at)
            piece = content[at : at + width - 1 + length]
            digest = hashlib.sha256(piece).digest()
            if together == 1:
                yield row, low + at, 1, core - at, single, None, digest, digest
            else:
                nearest = core - (core - at) // together * together
                shared = content[nearest : nearest - together + 1 + length]
                inner = hashlib.sha256(shared).digest()
                yield row, low + at, width, core - at, single, piece, digest, inner
            at += width

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _RUNS_AT_ONCE):
                part = batch.slice(at, _RUNS_AT_ONCE)
                rows = zip(*(column.to_pylist() for column in part.columns))
                made = zip(*(piece for run in rows for piece in cut(*run)))
                yield pa.RecordBatch.from_arrays(list(map(pa.array, made, types)), names)

    return runs.select(*names[:-2]).mapInArrow(work, schema)


def _counted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """As ``_sorted_spans``, for anchors of any frequency: pieces count by their digests.

    A piece of several windows that repeats as a whole is one row. Of each different piece one is
    cut into its windows, which are then counted in the same way, unless no other piece has the
    bytes that all its windows share.
    """
    place = F.col("place")
    runs = contexts.select(
        "row",
        F.shiftright(place, 16).alias("low"),
        (F.shiftright(place, 8).bitwiseAND(F.lit(0xFF)) + 1).alias("windows"),
        place.bitwiseAND(F.lit(0xFF)).alias("core"),
        "single",
        "content",
    )
    pieces = _pieces(runs, length, COUNTED_TOGETHER)
    # Kept, as the counts below, so that the joins read plain shuffles and can split them.
    different = keep_table(
        pieces.groupBy("digest").agg(
            F.count("*").alias("n"),
            F.min(F.struct("row", "low", "windows", "core", "single")).alias("one"),
            F.min("content").alias("content"),
            F.min("inner").alias("inner"),
        )
    )
    inners = different.groupBy("inner").agg(F.count("*").alias("pieces")).where("pieces > 1")
    windows = _pieces(
        different.join(keep_table(inners.select("inner")), "inner", "left_semi").select(
            "one.row",
            "one.low",
            "one.windows",
            "one.core",
            F.expr("n = 1 AND one.single").alias("single"),
            "content",
        ),
        length,
        1,
    )
    often = keep_table(windows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1"))

    def hits(found: DataFrame, repeated: DataFrame) -> DataFrame:
        high = F.col("low") + F.col("windows") - 1 + length
        alone = found.where("single").select("row", "low", "windows", "digest")
        joined = alone.join(repeated.select("digest"), "digest")
        return joined.select("row", "low", high.alias("high"))

    return hits(pieces, different.where("n > 1")).unionByName(hits(windows, often))


def _contents(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of contexts (``row``, ``anchor``, ``place``, ``single``, ``hot``)."""
    fields = ("anchor", "place", "single", "hot")
    lists = wanted.groupBy("row").agg(F.collect_list(F.struct(*fields)).alias("wanted"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                text = batch.column(1)[at].as_buffer()
                inside = batch.column(2).slice(at, 1).flatten()
                anchor, place, single, hot = inside.flatten()
                cuts = []
                for packed in place.to_pylist():
                    first = packed >> 16
                    cuts.append(bytes(text[first : first + (packed >> 8 & 0xFF) + length]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(0)[at].as_py()] * len(cuts), pa.int64()),
                        anchor,
                        place,
                        single,
                        hot,
                        pa.array(cuts, pa.binary()),
                    ],
                    ["row", *fields, "content"],
                )

    # A list is as long as its text at most; the small side is the one to hash.
    found = rows.join(lists.hint("shuffle_hash"), "row").select("row", "text", "wanted")
    return found.mapInArrow(
        work,
        "row long, anchor long, place long, single boolean, hot boolean, content binary",
    )


def repeated_spans(rows: DataFrame, length: int) -> DataFrame:
    """Spans ``row``, ``low``, ``high`` of bytes (``low`` on, before ``high``), overlapping ones too.

    They cover the bytes of every ``length``-byte string that starts elsewhere as well.
    """
    anchors = _anchor_rows(rows, length)
    often = (
        anchors.groupBy("anchor")
        .agg(
            F.count("*").alias("n"),
            F.min("context").alias("least"),
            F.max("context").alias("most"),
        )
        .where("n > 1")
        .select("anchor", (F.col("least") != F.col("most")).alias("mixed"))
    )
    # Kept, so that the join reads plain shuffles, which it can split at a frequent anchor.
    candidates = keep_table(anchors.join(keep_table(often), "anchor"))
    whole = (
        F.shiftright("place", 16).alias("low"),
        (F.shiftright("place", 16) + F.shiftright("place", 8).bitwiseAND(F.lit(0xFF)) + length)
        .alias("high"),
    )
    alike = candidates.where("NOT mixed").select("row", *whole)
    mixed = candidates.where("mixed")
    # Equal contexts repeat each other; one of each is compared with the other contexts.
    contexts = keep_table(
        mixed.groupBy("anchor", "context").agg(
            F.count("*").alias("copies"), F.min(F.struct("row", "place")).alias("one")
        )
    )
    crowded = (
        contexts.groupBy("anchor")
        .agg(F.count("*").alias("different"))
        .where(F.col("different") > SORTED_TOGETHER)
        .select("anchor", F.lit(True).alias("hot"))
    )
    copied = mixed.join(contexts.where("copies > 1").select("anchor", "context"), ["anchor", "context"])
    compared = contexts.join(crowded, "anchor", "left").select(
        "anchor",
        "one.row",
        "one.place",
        (F.col("copies") == 1).alias("single"),
        F.coalesce("hot", F.lit(False)).alias("hot"),
    )
    contents = _contents(rows, compared, length)
    return (
        alike.unionByName(copied.select("row", *whole))
        .unionByName(_sorted_spans(contents.where("NOT hot"), length))
        .unionByName(_counted_spans(contents.where("hot"), length))
    )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = 200
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``n_bytes``, ``spans`` (low, high) and ``kept`` (binary).

    Texts are UTF-8 bytes, NULL is empty. A byte is removed if a ``length``-byte string over it
    also starts anywhere else, in the same text too; all is judged on the input. ``spans`` are the
    maximal removed runs in order, ``kept`` the other bytes. Rows that repeat are documents of
    their own. ``docs`` must give its rows in the same order each time it is computed, as a scan
    of files does. Contexts with equal 64-bit hashes beside an equal anchor hash count as equal.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"),
    )
    spans = (
        repeated_spans(rows, length)
        .groupBy("row")
        .agg(F.collect_set(F.struct("low", "high")).alias("found"))
    )
    schema = with_fields(
        rows.select("id").schema,
        "n_bytes long, spans array<struct<low: long, high: long>>, kept binary",
    )
    span_type = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, merged, kept = [], [], []
            for at in range(batch.num_rows):
                text = batch.column(1)[at].as_buffer()
                inside = batch.column(2).slice(at, 1).flatten()
                low, high = (part.to_numpy() for part in inside.flatten())
                order = np.argsort(low, kind="stable")
                low, reach = low[order], np.maximum.accumulate(high[order])
                opens = np.append(True, low[1:] > reach[:-1])[: len(low)]
                ends = reach[np.append(opens[1:], True)[: len(low)]]
                runs = list(zip(low[opens].tolist(), ends.tolist()))
                edges = [0, *(edge for run in runs for edge in run), text.size]
                sizes.append(text.size)
                merged.append([{"low": a, "high": b} for a, b in runs])
                kept.append(b"".join(bytes(text[a:b]) for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(merged, span_type),
                    pa.array(kept, pa.binary()),
                ],
                schema.names,
            )

    joined = rows.join(spans.hint("shuffle_hash"), "row", "left")
    return joined.select("id", "text", "found").mapInArrow(work, schema)
