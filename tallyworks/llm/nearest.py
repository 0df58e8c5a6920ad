"""Exact search for the highest inner products with a pivot-distance index.

Vectors of whole numbers are put on a sphere: each gets one more component that brings its length
to that of the longest, and a query gets none and is stretched to it. The order of the inner
products with a query is then that of the angles to it, and angles are a metric.

The index: a vector's cell is its nearest pivot, its place in the cell the angle to that pivot.
Cells are cut into annuli by quantiles of the angle, and a large annulus is dealt to several
chunks. A query goes to the few annuli that can be nearest first; that gives a score to beat.
Then it goes to every annulus that the triangle inequality doesn't rule out: one at angles
``low`` to ``high`` of a pivot at angle ``a`` of the query has nothing nearer than ``low - a`` or
``a - high``; and nothing of a cell is nearer than half of what its pivot is farther than the nearest
one. Inside a chunk, rings of ``RING`` vectors are visited outwards from the query's own angle,
until the bound says that no more can be found. So the result is exact; only the pivots are drawn
from a sample (``SAMPLE`` vectors), which bears on speed alone.

Equal vectors are one entry with the smallest ids, one more than are wanted: the others can be in
no result. Queries with equal vectors are searched once. What is sent to every task, pivots and
bounds of annuli, is bounded by ``PIVOTS`` and ``ANNULI``, whatever the data.

Defined cases: vectors that are NULL, hold NULL, NaN or infinity, or have a scaled component
beyond 2^28 (whose products could leave a long) take no part. A shorter vector ends in zeros.
Rows that repeat are candidates, and queries, each on its own; a row is never its own result, but
may be that of an equal row. Ties go to the smaller id, a NULL id comes last and is no query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyworks.llm import common  # noqa: F401 - functions of this package travel with tasks
from tallyworks.session import keep_table

PIVOTS = 64
SAMPLE = 2_000
# Annuli of a cell at most; fewer where a cell is small. Rows of a chunk of an annulus.
ANNULI = 64
CHUNK_ROWS = 8_192
RING = 1_024
# Annuli that a query visits before the others are ruled out.
FIRST = 4
# Queries that meet a chunk in one task, about.
QUERIES_TOGETHER = 65_536

_LIMIT = 1 << 28
# Angles are compared with some room for rounding.
_ROOM = 1e-6
_NO_ID = np.iinfo(np.int64).max

_PAIR = "cell int, annulus int, chunk int, part int"


def scaled(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id``, ``vector`` (floor of ``scale`` times each component, as 32-bit integers), ``norm2``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            values = column.flatten().cast(pa.float64()).fill_null(np.nan)
            numbers = values.to_numpy(zero_copy_only=False) * scale
            fit = np.isfinite(numbers) & (np.abs(numbers) < _LIMIT)
            numbers = np.floor(np.where(fit, numbers, 0)).astype("<i4")
            ends = np.cumsum(sizes)
            amiss = np.concatenate(([0], np.cumsum(~fit)))
            good = column.is_valid().to_numpy(zero_copy_only=False)
            good &= amiss[ends] == amiss[ends - sizes]
            squares = np.concatenate(([0], np.cumsum(numbers.astype(np.int64) ** 2)))
            found = [numbers[end - n : end].tobytes() for end, n in zip(ends[good], sizes[good])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).filter(pa.array(good)),
                    pa.array(found, pa.binary()),
                    pa.array((squares[ends] - squares[ends - sizes])[good], pa.int64()),
                ],
                ["id", "vector", "norm2"],
            )

    wanted = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col))
    return wanted.mapInArrow(work, "id long, vector binary, norm2 long")


def matrix(vectors: list[bytes], width: int) -> np.ndarray:
    """Vectors as rows of a matrix, shorter ones filled with zeros."""
    if all(len(each) == 4 * width for each in vectors):
        flat = np.frombuffer(b"".join(vectors), "<i4")
    else:
        flat = np.frombuffer(b"".join(each[: 4 * width].ljust(4 * width, b"\0") for each in vectors), "<i4")
    return flat.reshape(len(vectors), width).astype(np.float64)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of rows: in floating point where no sum can be rounded."""
    most = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(1, left.shape[1])
    if most < 1 << 53:
        return (left @ right.T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


@dataclass
class Sphere:
    """The pivots, and angles between points of the sphere."""

    pivots: np.ndarray
    lifts: np.ndarray
    radius: float

    @property
    def width(self) -> int:
        return self.pivots.shape[1]

    @staticmethod
    def of(sample: np.ndarray, norm2: int, count: int) -> Sphere:
        """Pivots from a sample: each the farthest from those before it."""
        radius = max(1.0, float(norm2) ** 0.5)
        lifts = np.sqrt(np.maximum(0, radius**2 - (sample**2).sum(axis=1)))
        points = np.column_stack([sample, lifts])
        chosen, near = [], np.full(len(points), -np.inf)
        while len(chosen) < min(count, len(points)):
            # The first is the one that is farthest from nothing yet: the first of the sample.
            at = int(np.argmin(near)) if chosen else 0
            if chosen and near[at] >= radius**2 * (1 - 1e-12):
                break
            chosen.append(at)
            near = np.maximum(near, points @ points[at])
        return Sphere(sample[chosen], lifts[chosen], radius)

    def of_entries(self, vectors: np.ndarray) -> np.ndarray:
        """Angle of each vector of the index (rows) to each pivot."""
        lifts = np.sqrt(np.maximum(0, self.radius**2 - (vectors**2).sum(axis=1)))
        cosine = (vectors @ self.pivots.T + np.outer(lifts, self.lifts)) / self.radius**2
        return np.arccos(np.clip(cosine, -1, 1))

    def of_queries(self, vectors: np.ndarray) -> np.ndarray:
        """Angle of each query (rows) to each pivot."""
        return self.of_scores(vectors @ self.pivots.T, vectors)

    def of_scores(self, scores: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """The angle at which an entry has a score with a query; a zero query rules nothing out."""
        length = np.sqrt((vectors**2).sum(axis=1))
        length = length.reshape(-1, *[1] * (scores.ndim - 1)) * self.radius
        cosine = np.divide(scores, length, out=np.full(scores.shape, -1.0), where=length > 0)
        return np.arccos(np.clip(cosine, -1, 1))


class Best:
    """The best entries found so far for each of some queries, ``wanted`` rows each."""

    def __init__(self, floors: np.ndarray, wanted: int) -> None:
        self.floors, self.wanted = floors, wanted
        # Place of the query, score, id, entry.
        self.rows = np.zeros((4, 0), np.int64)

    def add(self, owners: np.ndarray, scores: np.ndarray, entries: np.ndarray, ids: list) -> None:
        """Take entries in by their scores; ``ids`` are the ids of each entry of the chunk."""
        lists = [ids[at] for at in entries.tolist()]
        each = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = [_NO_ID if one is None else one for some in lists for one in some]
        new = np.stack([owners, scores, np.zeros_like(scores), entries]).repeat(each, axis=1)
        new[2] = np.array(flat, np.int64)
        rows = np.concatenate([self.rows, new], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], rows[0])
        rank = np.arange(rows.shape[1]) - first
        last = rows[:, rank == self.wanted - 1]
        self.floors[last[0]] = np.maximum(self.floors[last[0]], last[1])
        self.rows = rows[:, rank < self.wanted]


def search_chunk(
    sphere: Sphere,
    entries: np.ndarray,
    ids: list,
    angles: np.ndarray,
    queries: np.ndarray,
    own: np.ndarray,
    floors: np.ndarray,
    wanted: int,
) -> np.ndarray:
    """The best rows for some queries among a chunk's entries, which ascend by angle.

    Rings are visited from the queries' own angles outwards. A ring is left out for a query
    whose score to beat is out of its reach, and the queries end one by one.
    """
    best = Best(floors.copy(), wanted)
    opens = np.arange(0, len(entries), RING)
    low = angles[opens]
    high = angles[np.append(opens[1:], len(entries)) - 1]
    bound = np.maximum(0, np.maximum(low[None, :] - own[:, None], own[:, None] - high[None, :]))
    for ring in np.argsort(bound.min(axis=0), kind="stable"):
        reach = sphere.of_scores(best.floors.astype(np.float64), queries)
        live = np.flatnonzero(bound[:, ring] <= reach + _ROOM)
        if not len(live):
            continue
        part = slice(opens[ring], opens[ring] + RING)
        scores = products(queries[live], entries[part])
        least = best.floors[live]
        if scores.shape[1] > wanted:
            kth = np.partition(scores, scores.shape[1] - wanted, axis=1)[:, -wanted]
            least = np.maximum(least, kth)
        rows, columns = np.nonzero(scores >= least[:, None])
        best.add(live[rows], scores[rows, columns], columns + opens[ring], ids)
    return best.rows


def _classes(vectors: DataFrame, wanted: int) -> DataFrame:
    """One row for each different vector: its number ``entry``, and its ``wanted`` smallest ids.

    What is not among a task's smallest goes before the shuffle, so a vector that makes up much
    of the table costs no more than others.
    """
    ranked = Window.partitionBy("vector").orderBy(F.asc_nulls_last("id"))
    few = vectors.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= wanted)
    member = F.struct("rank", "id")
    grouped = few.groupBy("vector").agg(
        F.first("norm2").alias("norm2"),
        F.sort_array(F.collect_list(member))["id"].alias("ids"),
    )
    return keep_table(grouped.withColumn("entry", F.monotonically_increasing_id()))


def _draw(classes: DataFrame, pivots: int) -> Sphere:
    norm2, width = classes.agg(F.max("norm2"), F.max(F.octet_length("vector"))).first()
    sample = classes.orderBy(F.xxhash64("vector"), "vector").select("vector").limit(SAMPLE)
    drawn = [bytes(row.vector) for row in sample.collect()]
    return Sphere.of(matrix(drawn, (width or 0) // 4), norm2 or 0, pivots)


def _placed(classes: DataFrame, shared) -> DataFrame:
    """Entries with their ``cell`` and ``angle``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sphere = shared.value
        for batch in batches:
            found = sphere.of_entries(matrix(batch.column(1).to_pylist(), sphere.width))
            cells = found.argmin(axis=1)
            angles = found[np.arange(len(found)), cells]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells.astype(np.int32)), pa.array(angles)],
                ["entry", "vector", "ids", "cell", "angle"],
            )

    wanted = classes.select("entry", "vector", "ids")
    schema = "entry long, vector binary, ids array<long>, cell int, angle double"
    return keep_table(wanted.mapInArrow(work, schema))


@dataclass
class Index:
    """Entries by cell, annulus and chunk, and the bounds of the annuli."""

    entries: DataFrame
    annuli: dict[str, np.ndarray]


def _index(placed: DataFrame) -> Index:
    steps = [step / ANNULI for step in range(1, ANNULI)]
    cells = placed.groupBy("cell").agg(
        F.count("*").alias("size"), F.percentile_approx("angle", steps, 10_000).alias("cuts")
    )
    # A small cell takes every second, fourth ... of the cuts.
    most = F.least(F.lit(ANNULI), F.ceil(F.col("size") / CHUNK_ROWS))
    step = F.ceil(F.lit(ANNULI) / most).cast("int")
    cells = cells.select(
        "cell", F.filter("cuts", lambda _, at: (at + 1) % step == 0).alias("cuts")
    )
    annulus = F.size(F.filter("cuts", lambda cut: cut < F.col("angle")))
    cut = placed.join(F.broadcast(cells), "cell").withColumn("annulus", annulus).drop("cuts")
    bounds = cut.groupBy("cell", "annulus").agg(
        F.min("angle").alias("low"), F.max("angle").alias("high"), F.count("*").alias("size")
    )
    # PIVOTS x ANNULI rows at most.
    chunks = bounds.withColumn("chunks", F.ceil(F.col("size") / CHUNK_ROWS).cast("int"))
    table = chunks.orderBy("cell", "annulus").toArrow()
    annuli = {name: table.column(name).to_numpy() for name in ("cell", "annulus", "low", "high", "chunks")}
    dealt = cut.join(F.broadcast(chunks.select("cell", "annulus", "chunks")), ["cell", "annulus"])
    chunk = F.pmod(F.xxhash64("entry"), F.col("chunks")).cast("int").alias("chunk")
    entries = dealt.select("cell", "annulus", chunk, "entry", "vector", "ids", "angle")
    return Index(entries, annuli)


def _sent(queries: DataFrame, shared, parts: int, later: bool) -> DataFrame:
    """Queries with the chunks that they are sent to, first or after that."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sphere, annuli = shared.value
        cell = annuli["cell"]
        for batch in batches:
            floors = batch.column(2).to_numpy(zero_copy_only=False)
            vectors = matrix(batch.column(1).to_pylist(), sphere.width)
            angles = sphere.of_queries(vectors)
            own = angles[:, cell]
            bound = np.maximum(0, np.maximum(annuli["low"] - own, own - annuli["high"]))
            bound = np.maximum(bound, (own - angles.min(axis=1)[:, None]) / 2)
            # Of equal bounds, the nearer pivot's annulus is the first.
            order = np.lexsort((own, bound), axis=1)
            goes = np.zeros(bound.shape, bool)
            np.put_along_axis(goes, order[:, :FIRST], True, axis=1)
            if later:
                reach = sphere.of_scores(floors.astype(np.float64), vectors)
                goes = ~goes & (bound <= reach[:, None] + _ROOM)
            rows, columns = np.nonzero(goes)
            each = annuli["chunks"][columns]
            chunk = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            rows, columns = rows.repeat(each), columns.repeat(each)
            part = batch.column(0).to_numpy()[rows] % parts
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cell[columns].astype(np.int32)),
                    pa.array(annuli["annulus"][columns].astype(np.int32)),
                    pa.array(chunk.astype(np.int32)),
                    pa.array(part.astype(np.int32)),
                    pa.array(np.ones(len(rows), np.int32)),
                    *(column.take(pa.array(rows)) for column in batch.columns),
                    pa.array(own[rows, columns]),
                ],
                ["cell", "annulus", "chunk", "part", "kind", "entry", "vector", "floor", "angle"],
            )

    schema = f"{_PAIR}, kind int, entry long, vector binary, floor long, angle double"
    return queries.select("entry", "vector", "floor").mapInArrow(work, schema)


def _visited(index: Index, sent: DataFrame, shared, parts: int, wanted: int) -> DataFrame:
    """``query``, ``score``, ``id``, ``entry``: the best of each chunk for the queries sent to it.

    A chunk's entries come before its queries, which then pass by in batches; so a task holds
    one chunk and one batch, however many queries there are.
    """
    place = ["cell", "annulus", "chunk", "part"]
    entries = index.entries.withColumns(
        {
            "part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))),
            "kind": F.lit(0),
            "floor": F.lit(None).cast("long"),
        }
    )
    both = entries.unionByName(sent.withColumn("ids", F.lit(None).cast("array<long>")))
    names = [*place, "kind", "entry", "vector", "ids", "angle", "floor"]
    both = both.select(*names).repartition(*place).sortWithinPartitions(*place, "kind", "angle")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sphere = shared.value[0]
        here, held, loaded = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(at).to_numpy() for at in range(5)], axis=1)
            if not len(keys):
                continue
            opens = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
            for start, stop in zip(opens, np.append(opens[1:], len(keys))):
                place, kind = tuple(keys[start, :4]), keys[start, 4]
                run = batch.slice(start, stop - start)
                if place != here:
                    here, held, loaded = place, [], None
                if not kind:
                    held.append(run)
                    continue
                if not held:
                    continue
                if loaded is None:
                    table = pa.Table.from_batches(held)
                    loaded = (
                        matrix(table.column("vector").to_pylist(), sphere.width),
                        table.column("ids").to_pylist(),
                        table.column("angle").to_numpy(),
                        table.column("entry").to_numpy(),
                    )
                vectors, ids, angles, numbers = loaded
                found = search_chunk(
                    sphere,
                    vectors,
                    ids,
                    angles,
                    matrix(run.column("vector").to_pylist(), sphere.width),
                    run.column("angle").to_numpy(),
                    run.column("floor").to_numpy(zero_copy_only=False),
                    wanted,
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(run.column("entry").to_numpy()[found[0]]),
                        pa.array(found[1]),
                        pa.array(found[2], mask=found[2] == _NO_ID),
                        pa.array(numbers[found[3]]),
                    ],
                    ["query", "score", "id", "entry"],
                )

    return both.mapInArrow(work, "query long, score long, id long, entry long")


def _best(found: DataFrame, wanted: int) -> DataFrame:
    """``query``, ``found``: its best rows in order. Each task first drops all but its own best."""
    order = Window.partitionBy("query").orderBy(
        F.desc("score"), F.asc_nulls_last("id"), "entry"
    )
    ranked = found.withColumn("place", F.row_number().over(order))
    row = F.struct("place", "score", "id", "entry")
    few = ranked.where(F.col("place") <= wanted)
    return few.groupBy("query").agg(F.sort_array(F.collect_list(row)).alias("found"))


def top_k(
    rows: DataFrame,
    is_query: Column,
    k: int,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 64,
    pivots: int = PIVOTS,
) -> DataFrame:
    """For each query its ``k`` other rows of highest score: ``query_id``, ``rank``, ``id``, ``score``.

    ``is_query`` is a condition on the column ``id``. A score is the inner product of the scaled
    vectors. With fewer rows than ``k``, all; with no other row, none.
    """
    wanted = k + 1  # a query's own row may be among them
    context = rows.sparkSession.sparkContext
    vectors = keep_table(scaled(rows, id_col, vector_col, scale))
    classes = _classes(vectors, wanted)
    sphere = _draw(classes, pivots)
    placed = _placed(classes, context.broadcast(sphere))
    index = _index(placed)
    shared = context.broadcast((sphere, index.annuli))

    asked = keep_table(
        vectors.where(is_query).select(F.col("id").alias("query_id"), "vector")
        .join(classes.select("vector", "entry"), "vector")
    )
    lowest = F.lit(np.iinfo(np.int64).min // 2)
    queries = asked.groupBy("entry").agg(F.first("vector").alias("vector"))
    parts = -(-max(1, asked.count()) // QUERIES_TOGETHER)
    first = keep_table(
        _visited(index, _sent(queries.withColumn("floor", lowest), shared, parts, False), shared, parts, wanted)
    )
    begun = _best(first, wanted)
    floor = F.when(F.size("found") == wanted, F.element_at("found", -1)["score"])
    floors = begun.select(F.col("query").alias("entry"), floor.alias("floor"))
    lifted = queries.join(floors, "entry", "left").withColumn("floor", F.coalesce("floor", lowest))
    rest = _visited(index, _sent(lifted, shared, parts, True), shared, parts, wanted)
    best = _best(first.unionByName(rest), wanted)

    met = asked.join(best.withColumnRenamed("query", "entry"), "entry")
    mine = F.filter(
        "found", lambda one: (one["id"] == F.col("query_id")) & (one["entry"] == F.col("entry"))
    )
    own = F.coalesce(F.try_element_at(mine, F.lit(1))["place"], F.lit(0))
    others = F.slice(F.filter("found", lambda one: one["place"] != own), 1, k)
    return met.select("query_id", F.posexplode(others).alias("at", "one")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("one.id").alias("id"), F.col("one.score").alias("score")
    )
