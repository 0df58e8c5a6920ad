"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vectors of three letters in a row, each
rotated by its place, are multiplied into the vector of their trigram; the trigram vectors of a
text add up to its profile; the profiles of a language's texts add up to a prototype. A text
gets the language whose prototype has the largest cosine with its profile.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import crc_remainder, per_worker, with_fields

DIMENSIONS = 1024
SEED = 20_11
UNDETERMINED = "und"
# Below this cosine a text looks like no language that was learned. Chance alone gives a spread
# of 1 / sqrt(1024) = 0.03. A text of few characters proves nothing either way.
LEAST_COSINE = 0.05
LEAST_CHARS = 200

# Characters worked on at once, trigrams whose vectors are kept, documents in one product.
_PIECE = 1 << 20
_KEPT = 16_384
_BLOCK = 32


class Letters:
    """Lower case and letters of all code points, and the vectors of trigrams."""

    def __init__(self, dimensions: int, seed: int) -> None:
        self.dimensions, self.seed = dimensions, seed
        # 0 stands for everything that is no letter.
        self.fold = np.zeros(0x110000, np.uint32)
        for point in range(0x110000):
            lowered = chr(point).lower()[0]
            if lowered.isalpha():
                self.fold[point] = ord(lowered)
        self.letter_vectors: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.table = np.empty((_KEPT, dimensions), np.int8)

    def trigrams(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Different trigrams of a text and how often each comes.

        Runs of letters are framed by a gap; nothing reaches over a gap but its own two ends.
        """
        all_codes, all_counts = [], []
        # Two characters more than the step, so that pieces share no trigram and lose none.
        for start in range(0, max(1, len(text)), _PIECE):
            piece = text[max(0, start - 2) : start + _PIECE]
            raw = np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32)
            folded = self.fold[raw]
            if start == 0:
                folded = np.concatenate((np.zeros(1, np.uint32), folded))
            if start + _PIECE >= len(text):
                folded = np.concatenate((folded, np.zeros(1, np.uint32)))
            if len(folded) < 3:
                continue
            a, b, c = folded[:-2], folded[1:-1], folded[2:]
            real = b != 0
            a, b, c = a[real], b[real], c[real]
            codes = (a.astype(np.uint64) << np.uint64(42)) | (b.astype(np.uint64) << np.uint64(21))
            found, counts = np.unique(codes | c, return_counts=True)
            all_codes.append(found)
            all_counts.append(counts)
        if len(all_codes) == 1:
            return all_codes[0], all_counts[0]
        if not all_codes:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        codes, places = np.unique(np.concatenate(all_codes), return_inverse=True)
        counts = np.bincount(places, np.concatenate(all_counts)).astype(np.int64)
        return codes, counts

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letter_vectors:
            draw = np.random.default_rng([self.seed, point])
            self.letter_vectors[point] = draw.integers(0, 2, self.dimensions).astype(np.int8) * 2 - 1
        return self.letter_vectors[point]

    def vector(self, code: int) -> np.ndarray:
        first, second, third = code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF
        bound = np.roll(self.letter(first), 2) * np.roll(self.letter(second), 1)
        return bound * self.letter(third)

    def places(self, codes: np.ndarray) -> np.ndarray:
        """Rows of the vector table that hold these trigrams. At most ``_KEPT`` at once."""
        rows = self.rows
        missing = [code for code in codes.tolist() if code not in rows]
        if len(rows) + len(missing) > _KEPT:
            rows.clear()
            missing = codes.tolist()
        for code in missing:
            rows[code] = at = len(rows)
            self.table[at] = self.vector(code)
        return np.fromiter(map(rows.__getitem__, codes.tolist()), np.int64, len(codes))

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The profile of one bag of trigrams, however large."""
        total = np.zeros(self.dimensions)
        for start in range(0, len(codes), _KEPT):
            part = slice(start, start + _KEPT)
            vectors = self.table[self.places(codes[part])].astype(np.float32)
            total += counts[part].astype(np.float32) @ vectors
        return total

    def bundles(self, bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Profiles of a block of texts, by one matrix product over their trigrams."""
        sizes = [len(codes) for codes, _ in bags]
        if sum(sizes) == 0:
            return np.zeros((len(bags), self.dimensions))
        joined, places = np.unique(
            np.concatenate([codes for codes, _ in bags]), return_inverse=True
        )
        if len(joined) > _KEPT:
            return np.stack([self.bundle(*bag) for bag in bags])
        weights = np.zeros((len(bags), len(joined)), np.float32)
        weights[np.repeat(np.arange(len(bags)), sizes), places] = np.concatenate(
            [counts for _, counts in bags]
        )
        return weights @ self.table[self.places(joined)].astype(np.float32)


def _letters(dimensions: int, seed: int) -> Letters:
    return per_worker(("letters", dimensions, seed), lambda: Letters(dimensions, seed))


def prototypes(
    labelled: DataFrame,
    text_col: str,
    lang_col: str,
    *,
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
) -> dict[str, list[float]]:
    """The prototype of each language: the sum of its texts' profiles, at length 1.

    Rows without text or language are left out. Every task adds up its own texts first and
    sends one vector per language; the result has as many numbers as languages times
    dimensions.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters(dimensions, seed)
        sums: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(dimensions, np.int64))
        bags: dict[str, list] = defaultdict(list)

        def settle(lang: str) -> None:
            codes, places = np.unique(
                np.concatenate([codes for codes, _ in bags[lang]]), return_inverse=True
            )
            counts = np.bincount(places, np.concatenate([n for _, n in bags[lang]]))
            sums[lang] += np.rint(letters.bundle(codes, counts)).astype(np.int64)
            bags[lang] = []

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bags[lang].append(letters.trigrams(text))
            for lang in list(bags):
                if bags[lang]:
                    settle(lang)
        names = sorted(sums)
        at = np.tile(np.arange(dimensions, dtype=np.int32), len(names))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(names, dimensions).tolist(), pa.string()),
                pa.array(at, pa.int32()),
                pa.array(np.concatenate([sums[n] for n in names]) if names else [], pa.int64()),
            ],
            ["lang", "at", "value"],
        )

    parts = rows.mapInArrow(work, "lang string, at int, value long")
    summed = parts.groupBy("lang", "at").agg(F.sum("value").alias("value"))
    # One row per language and dimension.
    vectors: dict[str, np.ndarray] = {}
    for lang, at, value in summed.collect():
        vectors.setdefault(lang, np.zeros(dimensions))[at] = value
    lengths = {lang: np.linalg.norm(vector) for lang, vector in vectors.items()}
    return {
        lang: (vectors[lang] / lengths[lang]).tolist()
        for lang in sorted(vectors)
        if lengths[lang] > 0
    }


def identify(
    docs: DataFrame,
    learned: Mapping[str, list[float]],
    *,
    text_col: str = "text",
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``lang_pred`` (string) and ``score`` (cosine, 0 to 1) at the end.

    A text that is NULL or has no letter, and every text when nothing was learned, gets ``und``
    and 0. Of equal cosines the language first in the alphabet wins. Columns of these two names
    are replaced, all others stay.
    """
    names = sorted(learned)
    table = np.array([learned[name] for name in names], np.float64).reshape(-1, dimensions)
    rows = docs.drop("lang_pred", "score")
    schema = with_fields(rows.schema, "lang_pred string, score double")
    place = rows.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters(dimensions, seed)
        for batch in batches:
            texts = [text or "" for text in batch.column(place).to_pylist()]
            langs, scores = [], []
            for start in range(0, len(texts), _BLOCK):
                bags = [letters.trigrams(text) for text in texts[start : start + _BLOCK]]
                profiles = letters.bundles(bags)
                norms = np.linalg.norm(profiles, axis=1)
                for (codes, _), profile, norm in zip(bags, profiles, norms):
                    if not len(codes) or not names or norm == 0:
                        langs.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    cosines = np.round(table @ (profile / norm), 6)
                    best = int(cosines.argmax())
                    langs.append(names[best])
                    scores.append(float(min(1.0, max(0.0, cosines[best]))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                schema.names,
            )

    return rows.mapInArrow(work, schema)


def held_out(key: Column) -> Column:
    """The third of the documents that nothing is learned from."""
    return crc_remainder(key, 3) == 1


def learn(docs: DataFrame) -> dict[str, list[float]]:
    """Prototypes from the documents (``doc_id``, ``text``, ``lang``) that are not held out."""
    return prototypes(docs.where(~held_out(F.col("doc_id"))), "text", "lang")
