"""Benchmark decontamination by templates, in DataFrame functions alone.

Numbers, units and names become typed placeholders, so a benchmark question is found again with
other figures or other people in it. Windows of template words are joined by their hashes, and
so are windows of plain lower-cased words, which find copies whatever their case or slots; then
the slots are compared: a value must be replaced by the same value wherever it stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyworks.functions.once import once
from tallyworks.session import cut_lineage, keep_table

WINDOW = 8
# Ordinary words that a window has to have to be looked for as a template, however many
# placeholders stand beside them; a window with fewer is looked for by its plain words only.
LEAST_ORDINARY = 2
# A document is flagged for an item if this many words in a row are found, or this share of the
# item's windows.
LEAST_WORDS = 13
LEAST_SHARE = 0.5
# Windows of a benchmark that are broadcast at most, of 32 bytes each; beyond, both sides are
# shuffled.
BROADCAST_WINDOWS = 1_000_000

# Units of measure and money. Fixed values.
UNITS = (
    "mm cm km kg mg ml lb lbs oz ft mph kmh ghz mhz kwh usd eur gbp "
    "metre metres meter meters kilometre kilometres kilometer kilometers mile miles inch inches "
    "foot feet yard yards gram grams kilogram kilograms pound pounds ounce ounces ton tons litre "
    "litres liter liters gallon gallons second seconds minute minutes hour hours day days week "
    "weeks month months year years dollar dollars cent cents euro euros percent degrees"
).split()

# Goes before a word that is a name by its place; no text keeps it.
_NAME = "\ue000"
# The hashes that placeholders have in place of a word's.
_SLOTS = {"number": 1, "unit": 2, "name": 3}

# A document's words beside an item's, at one distance between their places.
ALIGNMENT = ("row", "item", "shift")


def words(text: Column | str) -> Column:
    """The lower-cased words of a text; names keep a mark in front.

    Words are runs of letters and digits. A word is a name if it starts with one capital letter
    and follows, after a single space, a lower-case letter, a digit, a comma or a semicolon: a
    capital at the start of a sentence tells nothing. NULL has no words.
    """
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    text = F.translate(text, _NAME, " ")
    marked = F.regexp_replace(text, r"(?<=[\p{Ll}0-9,;] )(?=\p{Lu}\p{Ll})", _NAME)
    return F.array_remove(F.split(F.lower(marked), rf"[^\p{{L}}\p{{N}}{_NAME}]+"), "")


def kind(word: Column) -> Column:
    """The placeholder of a word (``_SLOTS``), or NULL if it is ordinary."""
    return (
        F.when(word.startswith(_NAME), _SLOTS["name"])
        .when((word >= "0") & (word < ":"), _SLOTS["number"])
        .when(word.isin(UNITS), _SLOTS["unit"])
        .cast("long")
    )


def bare(word: Column) -> Column:
    """A word without the mark of a name."""
    return F.when(word.startswith(_NAME), F.substring(word, 2, 1 << 30)).otherwise(word)


def _windows(rows: DataFrame, keep: list[str], size: int) -> DataFrame:
    """``keep``, ``at`` (from 0), ``plain`` and ``hash`` of every window of ``size`` words.

    ``rows`` has the array ``words``. A window is hashed as a template, and, if it has slots, also
    by its plain words, which are the same in any case.
    """
    template = F.transform("words", lambda word: F.coalesce(kind(word), F.xxhash64(word)))
    plain = F.transform("words", lambda word: F.xxhash64(bare(word)))
    hashed = rows.where(F.size("words") >= size).select(
        *keep, once(F.struct(template.alias("template"), plain.alias("plain"))).alias("_forms")
    )
    last = F.size("_forms.template") - (size - 1)

    def forms(starts: Column, form: str) -> Column:
        return F.transform(
            starts,
            lambda at: F.struct(
                (at - 1).alias("at"),
                F.lit(form == "plain").alias("plain"),
                F.xxhash64(F.slice(F.col(f"_forms.{form}"), at, size)).alias("hash"),
            ),
        )

    slots = F.filter(
        F.sequence(F.lit(1), F.size("_forms.template")),
        lambda at: F.get("_forms.template", at - 1) != F.get("_forms.plain", at - 1),
    )
    around = F.transform(
        slots,
        lambda at: F.sequence(
            F.greatest(F.lit(1), F.least(at - (size - 1), last)), F.least(at, last)
        ),
    )
    slotted = F.array_distinct(F.flatten(around))
    every = forms(F.sequence(F.lit(1), last), "template")
    return hashed.select(*keep, F.inline(F.concat(every, forms(slotted, "plain"))))


def _hits(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """Runs of words that match in a row: ``row``, ``item``, ``shift``, ``first``, ``n``, ``size``.

    ``n`` is the number of windows in the run, those between included that were not looked for.
    """
    wanted = _windows(items, ["item", "words"], size)
    slots = F.size(F.filter(F.slice("words", F.col("at") + 1, size), lambda w: kind(w).isNotNull()))
    wanted = wanted.where(F.col("plain") | (slots <= size - LEAST_ORDINARY))
    wanted = cut_lineage(wanted.select("hash", "item", F.col("at").alias("place")))
    if wanted.count() <= BROADCAST_WINDOWS:
        wanted = F.broadcast(wanted)
    found = _windows(docs, ["row"], size).join(wanted, "hash")
    found = found.select("row", "item", (F.col("at") - F.col("place")).alias("shift"), "at")
    along = Window.partitionBy(*ALIGNMENT).orderBy("at")
    # A word between two windows that no window has does not match.
    apart = F.coalesce(F.col("at") - F.lag("at").over(along) > size, F.lit(False))
    runs = found.withColumn("run", F.sum(apart.cast("long")).over(along))
    return runs.groupBy(*ALIGNMENT, "run").agg(
        F.min("at").alias("first"),
        (F.max("at") - F.min("at") + 1).alias("n"),
        F.lit(size).alias("size"),
    ).drop("run")


def _consistent(runs: DataFrame) -> DataFrame:
    """Pieces of ``runs`` without a contradiction: their columns, ``changed`` and ``best``.

    An alignment is cut into its longest stretches in which an item's value is replaced by the
    same value wherever it stands; stretches may overlap. ``best`` marks the pieces of the stretch
    that has most windows: of stretches that contradict each other one counts.
    """
    values = runs.select(*ALIGNMENT, F.inline("slots"))
    same = Window.partitionBy(*ALIGNMENT, "theirs").orderBy("at")
    neighbours = values.select(
        *ALIGNMENT,
        F.lag("at").over(same).alias("before"),
        F.col("at").alias("stop"),
        (F.lag("mine").over(same) != F.col("mine")).alias("differ"),
    )
    broken = neighbours.where("differ").drop("differ")
    # A stretch starts with the alignment, or behind the first value of a contradiction.
    whole = runs.select(*ALIGNMENT).distinct().select(
        *ALIGNMENT, F.lit(-1).alias("before"), F.lit(None).cast("int").alias("stop")
    )
    later = (
        Window.partitionBy(*ALIGNMENT)
        .orderBy(F.desc("before"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    stretches = whole.unionByName(broken).select(
        *ALIGNMENT,
        (F.col("before") + 1).alias("start"),
        F.min("stop").over(later).alias("stop"),
    )
    end = F.col("first") + F.col("n") + F.col("size") - 1
    cut = runs.join(stretches, list(ALIGNMENT)).withColumn(
        "_end", F.least(end, F.col("stop"))
    )
    cut = cut.withColumn("first", F.greatest("first", "start")).withColumn(
        "n", F.col("_end") - F.col("first") - F.col("size") + 1
    )
    changed = F.exists(
        "slots",
        lambda slot: slot["changed"] & (slot["at"] >= F.col("first")) & (slot["at"] < F.col("_end")),
    )
    pieces = cut.where("n > 0").withColumn("changed", changed).drop("slots", "stop", "_end")
    of_one = Window.partitionBy(*ALIGNMENT, "start")
    rank = F.struct("_windows", -F.col("start"))
    summed = pieces.withColumn("_windows", F.sum("n").over(of_one))
    best = rank == F.max(rank).over(Window.partitionBy(*ALIGNMENT))
    return summed.withColumn("best", best).drop("_windows", "start")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    least_words: int = LEAST_WORDS,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """Per document and benchmark item that it gives away: ``row``, ``id``, ``item``, evidence.

    ``windows``: windows found in consistent runs; ``longest``: words of the longest run;
    ``share``: of the item's windows, each counted once; ``changed``: whether a slot has another value than the item.
    Items shorter than ``window`` words are looked for as a whole, from three words on. One or two
    words are found where they are all the words of a document, as they would be in countless
    others; items without words match nothing. ``row`` numbers the rows of ``docs`` in the
    order of the scan, which must be the same whenever it is computed. Items that repeat are
    taken once each; a NULL item id is an item like others.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
    )
    items = benchmark.select(
        F.col(item_col).alias("item_id"), once(words(item_text_col)).alias("words")
    )
    items = cut_lineage(
        items.where("size(words) >= 1").distinct().withColumn(
            "item", F.monotonically_increasing_id()
        )
    )
    brief, items = items.where("size(words) < 3"), items.where("size(words) >= 3")
    # Sizes below the full window: a handful of numbers.
    short = items.where(F.size("words") < window).select(F.size("words").alias("n")).distinct()
    worded = rows.select("row", once(words("text")).alias("words"))
    hits = _hits(worded, items.where(F.size("words") >= window), window)
    for size in sorted(row.n for row in short.collect()):
        hits = hits.unionByName(_hits(worded, items.where(F.size("words") == size), size))
    sized = items.select("item", "item_id", F.col("words").alias("item_words"))
    # Kept, as it is read twice and reads all texts.
    hits = keep_table(hits).join(sized, "item").withColumn(
        "all", F.size("item_words") - F.col("size") + 1
    )
    # What can still be flagged: places that repeat count each time here, so none is lost.
    total = hits.groupBy("row", "item").agg(
        F.sum("n").alias("total"), F.max(F.col("n") + F.col("size") - 1).alias("most")
    )
    strong = hits.join(total, ["row", "item"]).where(
        (F.col("most") >= least_words) | (F.col("total") >= F.col("all") * least_share)
    )
    strong = cut_lineage(strong.drop("total", "most"))
    texts = rows.join(strong.select("row").distinct(), "row", "left_semi")
    texts = texts.select("row", "id", once(words("text")).alias("words"))
    length = (F.col("n") + F.col("size") - 1).cast("int")
    pairs = F.transform(
        F.arrays_zip(
            F.slice("words", (F.col("first") + 1).cast("int"), length).alias("mine"),
            F.slice("item_words", (F.col("first") - F.col("shift") + 1).cast("int"), length)
            .alias("theirs"),
        ),
        lambda pair, at: F.struct(
            (F.col("first") + at).alias("at"),
            pair["theirs"].alias("theirs"),
            bare(pair["mine"]).alias("mine"),
            (bare(pair["mine"]) != bare(pair["theirs"])).alias("changed"),
        ),
    )
    slots = F.filter(pairs, lambda pair: kind(pair["theirs"]).isNotNull())
    compared = strong.join(texts, "row").select(
        "id", "item_id", *ALIGNMENT, "first", "n", "size", "all", slots.alias("slots")
    )
    # Kept, as it is read three times.
    pieces = _consistent(keep_table(compared))
    # Item places that an earlier piece has already are not counted again.
    place = F.col("first") - F.col("shift")
    before = (
        Window.partitionBy("row", "item")
        .orderBy(place, "n")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = F.max(F.when(F.col("best"), place + F.col("n"))).over(before)
    fresh = F.greatest(
        F.lit(0), place + F.col("n") - F.greatest(place, F.coalesce(reached, place))
    )
    found = (
        pieces.withColumn("fresh", F.when(F.col("best"), fresh).otherwise(0))
        .groupBy("row", "id", "item")
        .agg(
            F.any_value("item_id").alias("item_id"),
            F.sum(F.when(F.col("best"), F.col("n"))).alias("windows"),
            F.max(F.col("n") + F.col("size") - 1).alias("longest"),
            (F.sum("fresh") / F.any_value("all")).alias("share"),
            F.bool_or(F.col("best") & F.col("changed")).alias("changed"),
        )
    )
    found = found.where(
        (F.col("longest") >= least_words) | (F.col("share") >= least_share)
    ).select("row", "id", F.col("item_id").alias("item"), "windows", "longest", "share", "changed")
    if brief.isEmpty():
        return found
    return found.unionByName(_whole(rows, brief))


def _whole(rows: DataFrame, brief: DataFrame) -> DataFrame:
    """Documents that have the words of an item of one or two words and no others."""
    said = F.transform("words", bare).alias("said")
    mine = rows.select("row", "id", once(words("text")).alias("words")).where("size(words) < 3")
    theirs = brief.select(F.col("item_id").alias("item"), said, F.size("words").alias("longest"))
    return mine.select("row", "id", said).join(theirs, "said").select(
        "row",
        "id",
        "item",
        F.lit(1).cast("long").alias("windows"),
        F.col("longest").cast("long").alias("longest"),
        F.lit(1.0).alias("share"),
        F.lit(False).alias("changed"),
    )
