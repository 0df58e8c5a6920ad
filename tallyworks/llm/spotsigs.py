"""SpotSigs document fingerprints, in DataFrame functions alone.

A signature is a common word (the anchor) with the chain of content words that follow it. The set
of a text's signatures is its fingerprint; two fingerprints are as alike as their Jaccard. Sets of
very different sizes cannot be alike, so a similarity join lets only neighbouring bands of set
sizes meet, and every set offers only its rarest signatures as join keys.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tallyworks.functions.once import once

# Anchors: common words of English, German, French and Spanish. Fixed values.
ANCHORS = (
    "a an and are as at be by for from has he in is it of on or that the this to was were will "
    "with das dem den der des die ein eine ist nicht sich und von zu mit auf "
    "au aux dans du elle en est et il la le les par pas pour que qui sur un une "
    "con de del el es las lo los no para por se su y"
).split()
CHAIN = 3
# Anchors that a chain may step over to find its content words.
REACH = 6
# Documents that one bucket of neighbouring ids holds.
BUCKET_ROWS = 4096
BROADCAST_BUCKETS = 1_000_000

_MARK = "\ue000"


def with_signatures(
    docs: DataFrame, text_col: str, out: str, *, chain: int = CHAIN, reach: int = REACH
) -> DataFrame:
    """``docs`` with the sorted distinct signatures of a text column, as hashes (array of long).

    Words are runs of letters and digits, lower-cased. The chain of an anchor is the next
    ``chain`` content words, found by stepping over at most ``reach`` further anchors, or as many
    as there are. A text with words but without an anchor has all its words as its only signature;
    NULL and texts without words have the empty set. A column of the name ``out`` is replaced.
    """
    others = [name for name in docs.columns if name != out]
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    # A mark goes before every anchor: what the marks part is an anchor and its content words.
    padded = F.concat(F.lit(" "), words, F.lit(" "))
    anchor = f" (?=(?:{'|'.join(ANCHORS)}) )"
    parts = F.split(F.regexp_replace(padded, anchor, f" {_MARK}"), _MARK)
    content = F.transform(
        F.col("_parts"), lambda part: part.substr(F.instr(part, " ") + 1, F.length(part))
    )

    def signature(part: Column, at: Column) -> Column:
        following = F.array_join(F.slice(F.col("_contents"), at + 1, reach + 1), "")
        return F.xxhash64(
            F.substring_index(part, " ", 1), F.rtrim(F.substring_index(following, " ", chain))
        )

    # The first part stands before all anchors.
    chains = F.slice(F.transform(F.col("_parts"), signature), 2, F.size("_parts"))
    alone = F.when(F.trim(F.col("_parts")[0]) == "", F.array().cast("array<bigint>")).otherwise(
        F.array(F.xxhash64(F.col("_parts")[0]))
    )
    found = F.when(F.size("_parts") > 1, F.array_sort(F.array_distinct(chains))).otherwise(alone)
    return (
        docs.select(*others, once(parts).alias("_parts"))
        .select(*others, "_parts", once(content).alias("_contents"))
        .select(*others, once(found).alias(out))
    )


def likeness(left: Column | str, right: Column | str) -> Column:
    """Jaccard of two signature sets; 1 for two empty ones."""
    left, right = (F.col(c) if isinstance(c, str) else c for c in (left, right))
    shared = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - shared
    return F.when(either == 0, 1.0).otherwise(shared / either)


def printed(fingerprint: Column | str) -> Column:
    """A signature set as text: hexadecimal numbers in order, comma-joined."""
    return F.array_join(F.transform(fingerprint, F.hex), ",")


def by_neighbours(docs: DataFrame, id_col: str) -> tuple[DataFrame, WindowSpec]:
    """``docs`` dealt out so that each row's next one, by ascending id, is at hand; and the window.

    A lead over the window gives the next row; the last row's next is the first. Rows are bucketed
    by ranges of the id, and each bucket gets a copy (``_copy``) of the next one's first row, to be
    dropped after the lead, so texts travel once. Equal ids follow each other in the order of the
    scan; NULL ids come first.
    """
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    low, high, count = docs.agg(F.min(id_col), F.max(id_col), F.count("*")).first()
    low, high = low or 0, high or 0
    buckets = max(1, math.ceil(count / BUCKET_ROWS))
    width = max(1, math.ceil((high - low + 1) / buckets))
    bucket = F.coalesce(F.call_function("div", F.col(id_col) - low, F.lit(width)), F.lit(0))
    rows = rows.withColumn("_bucket", bucket)
    place = F.struct(F.col(id_col), F.col("_row"))
    firsts = rows.select("_bucket", "_row", place.alias("place")).groupBy("_bucket").agg(
        F.min("place").alias("place")
    )
    # One row per bucket: its first row, and the bucket before (the last one for the first).
    by_bucket = Window.orderBy("_bucket")
    last = F.max("_bucket").over(Window.partitionBy())
    heads = firsts.select(
        F.col("place._row").alias("_row"),
        F.coalesce(F.lag("_bucket").over(by_bucket), last).alias("_before"),
    )
    # Two numbers a bucket: small enough to send to every task, or else joined by a shuffle.
    if buckets <= BROADCAST_BUCKETS:
        heads = F.broadcast(heads)
    copies = (
        rows.drop("_bucket")
        .join(heads, "_row")
        .withColumnRenamed("_before", "_bucket")
        .withColumn("_copy", F.lit(True))
    )
    both = rows.withColumn("_copy", F.lit(False)).unionByName(copies)
    both = both.repartition(buckets, "_bucket")
    order = ("_copy", F.col(id_col).asc_nulls_first(), "_row")
    return both, Window.partitionBy("_bucket").orderBy(*order)


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint beside that of an edited copy and that of the next document.

    The edited copy has its last half (of code points, rounded down) replaced by as many from the
    start of the next text, or all of it. Columns ``id``, ``n_chars``, ``edited``, ``own``,
    ``changed`` (signature sets), ``near_edited``, ``near_next``. NULL texts are empty. ``docs``
    must give its rows in the same order whenever it is computed, as a scan of files does.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    both, order = by_neighbours(rows, "id")
    signed = with_signatures(both, "text", "own")
    following = F.lead(F.struct("text", "own")).over(order)
    paired = signed.withColumn("next", following).where("NOT _copy")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.col("text").substr(F.lit(1), F.col("n_chars").cast("int") - half),
        F.col("next.text").substr(F.lit(1), half),
    )
    changed = with_signatures(
        paired.withColumn("n_chars", F.length("text").cast("long")).select(
            "id", "n_chars", "own", F.col("next.own").alias("after"), once(edited).alias("edited")
        ),
        "edited",
        "changed",
    )
    return changed.select(
        "id",
        "n_chars",
        "edited",
        "own",
        "changed",
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "after").alias("near_next"),
    )


def similar(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    least: float = 0.8,
) -> tuple[DataFrame, DataFrame]:
    """Classes of equal fingerprints, and the links between classes at ``least`` or more.

    Returns membership (``id``, ``class_id``: the smallest id with the same set) and pairs
    (``a``, ``b``, ``likeness``) of class ids, ``a < b``, each once. Sets are grouped into bands of
    sizes, a band being ``1 / least`` times as wide as the one before, so alike sets are in the
    same or neighbouring bands. Of a set of ``s`` signatures the ``s - ceil(least s) + 1`` rarest
    are join keys; two alike sets share one of them. Empty sets only equal each other.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = with_signatures(rows, "text", "set").select("id", "set")
    classes = rows.groupBy("set").agg(F.min("id").alias("class_id"))
    members = rows.join(classes, "set").select("id", "class_id")
    sets = classes.where("size(set) > 0 AND class_id IS NOT NULL")
    items = sets.select("class_id", F.size("set").alias("size"), F.explode("set").alias("item"))
    often = items.groupBy("item").agg(F.count("*").alias("often"))
    # The position of an item among those of its set, rarest first.
    ranked = items.join(often, "item").withColumn(
        "rank",
        F.row_number().over(Window.partitionBy("class_id").orderBy("often", "item")),
    )
    keys = ranked.where(
        (F.col("rank") <= F.col("size") - F.ceil(F.col("size") * least - 1e-9) + 1)
        & (F.col("often") > 1)
    )
    band = F.floor(F.log("size") / F.log(F.lit(1 / least)) + 1e-9)
    keys = keys.select("class_id", "size", "item", band.alias("band"))
    probes = keys.select(
        F.col("class_id").alias("a"),
        F.col("size").alias("a_size"),
        "item",
        F.explode(F.array("band", F.col("band") + 1)).alias("band"),
    )
    found = (
        probes.join(keys, ["item", "band"])
        .where(
            (F.col("a_size") <= F.col("size"))
            & (F.col("a_size") >= F.col("size") * least - 1e-9)
            & (F.col("a") != F.col("class_id"))
        )
        .select(F.least("a", "class_id").alias("a"), F.greatest("a", "class_id").alias("b"))
        .distinct()
    )
    left = sets.select(F.col("class_id").alias("a"), F.col("set").alias("left"))
    right = sets.select(F.col("class_id").alias("b"), F.col("set").alias("right"))
    pairs = (
        found.join(left, "a")
        .join(right, "b")
        .select("a", "b", likeness("left", "right").alias("likeness"))
        .where(F.col("likeness") >= least - 1e-9)
    )
    return members, pairs
