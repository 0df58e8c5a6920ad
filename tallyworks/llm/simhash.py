"""SimHash near-duplicates, found by chains of fingerprint segments (pigeonring).

Cut two 64-bit fingerprints that differ in at most ``t`` bits into ``m`` segments laid in
a ring. Then a segment exists from which every chain of ``l`` consecutive segments differs
in at most ``l * t / m`` bits. With ``m = 2 t + 1`` the first two segments of that chain must
be equal, which makes a join key; the longer chains are compared next, and only what is left
gets the full Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import pieces, utf8_texts, with_fields
from tallyworks.llm.components import components
from tallyworks.session import cut_lineage, keep_table

BITS = 64
SEED = 42


def _bit_counts(shingles: list[bytes]) -> np.ndarray:
    """How many of the shingles' hashes have each bit set."""
    hashes = np.fromiter(
        map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles)
    )
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little")
    return bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, width: int) -> int:
    """SimHash of a UTF-8 text over shingles of ``width`` words, as a signed long."""
    counts, total, carried = np.zeros(BITS, np.int64), 0, []
    for piece in pieces(text):
        words = carried + piece.lower().split()
        shingles = list(map(b" ".join, zip(*(words[at:] for at in range(width)))))
        if shingles:
            counts += _bit_counts(shingles)
            total += len(shingles)
        carried = words[max(0, len(words) - width + 1) :]
    if not total and carried:
        counts, total = _bit_counts([b" ".join(carried)]), 1
    packed = np.packbits(counts * 2 > total, bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """Columns ``id`` and ``fingerprint`` (long), one row per row of ``docs``.

    Letters A-Z are lower-cased; words are runs of anything but ASCII white space; repeated
    shingles count each time; a bit is set if it is in over half of the hashes. A text with
    fewer words gives one shingle of all of them; a text without words, or NULL, gives 0.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = with_fields(rows.select("id").schema, "fingerprint long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text, width) for text in utf8_texts(batch.column(1))]
            yield pa.record_batch(
                [batch.column(0), pa.array(found, pa.int64())], ["id", "fingerprint"]
            )

    return rows.mapInArrow(work, schema)


def segment_masks(max_bits: int) -> list[int]:
    """Masks of ``2 * max_bits + 1`` segments that share the 64 bits out evenly."""
    count = 2 * max_bits + 1
    edges = [BITS * at // count for at in range(count + 1)]
    return [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _chain_holds(difference: Column, start: Column, masks: list[int], max_bits: int) -> Column:
    """Whether each chain from segment ``start`` on stays within its share of the budget."""
    count, holds = len(masks), F.lit(True)
    for length in range(3, count):
        budget = length * max_bits // count
        reach = [
            _signed(sum(masks[(first + step) % count] for step in range(length)))
            for first in range(count)
        ]
        mask = F.element_at(F.array(*map(F.lit, reach)), start + 1)
        holds = holds & (F.bit_count(difference.bitwiseAND(mask)) <= budget)
    return holds


def links(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Pairs ``a``, ``b`` of ids whose fingerprints differ, in ``max_bits`` bits or fewer.

    ``nodes`` has ``id`` and ``fingerprint``, each fingerprint once.
    """
    masks = segment_masks(max_bits)
    count = len(masks)
    if count > BITS // 2:
        raise ValueError(f"max_bits must be below {BITS // 4}")
    keys = [
        F.struct(
            F.lit(first).alias("start"),
            F.col("fingerprint")
            .bitwiseAND(F.lit(_signed(masks[first] | masks[(first + 1) % count])))
            .alias("key"),
        )
        for first in range(count)
    ]
    chains = nodes.select("id", "fingerprint", F.inline(F.array(*keys)))
    left = chains.select("start", "key", F.col("id").alias("a"), F.col("fingerprint").alias("fa"))
    right = chains.select("start", "key", F.col("id").alias("b"), F.col("fingerprint").alias("fb"))
    difference = F.col("fa").bitwiseXOR(F.col("fb"))
    return (
        left.join(right, ["start", "key"])
        .where(
            (F.col("fa") < F.col("fb"))
            & _chain_holds(difference, F.col("start"), masks, max_bits)
            & (F.bit_count(difference) <= max_bits)
        )
        .select("a", "b")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    width: int = 3,
    max_bits: int = 2,
) -> DataFrame:
    """Columns ``id``, ``fingerprint`` (long) and ``component``, one row per row of ``docs``.

    Fingerprints link at ``max_bits`` differing bits or fewer; the component is the smallest
    id that links reach. Equal fingerprints are brought down to one before pairs are looked
    for, so a group of copies costs as much as one text. Rows that repeat stay; a NULL id
    gets the component of its fingerprint, NULL if that has no other id.
    """
    found = keep_table(fingerprints(docs, id_col, text_col, width))
    nodes = cut_lineage(found.groupBy("fingerprint").agg(F.min("id").alias("id")))
    reached = components(links(nodes.where("id IS NOT NULL"), max_bits))
    classes = nodes.join(reached, nodes.id == reached.node, "left").select(
        "fingerprint", F.coalesce("component", "id").alias("component")
    )
    return found.join(classes, "fingerprint").select("id", "fingerprint", "component")


def hexadecimal(value: Column | str) -> Column:
    """A long as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
