"""Token ids in Parquet files made for selective reads.

One row per document: ``doc_id``, ``n_tokens``, ``offset`` (ids before it in its part) and the
list of ids. Rows are sorted by ``doc_id`` over the whole set of files. Ids are dictionary
encoded, the sorted numbers are delta encoded (second data page version), row groups and pages
have stated sizes, and the writer adds page indexes, so a read of a few documents touches a few
pages, and a read of the metadata touches no ids.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tallyworks.llm.common import per_worker, pieces, utf8_texts, with_fields

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
# Text that one task encodes, sorts and writes.
PART_BYTES = 24 << 20
# Parts of words that each Python worker keeps with their ids; twice as many until those of the
# time before go.
CACHED_PARTS = 500_000
# Text whose different parts are looked up together.
BLOCK_BYTES = 4 << 20

# A run of plain letters: of one byte, or of two in the Latin-1 block. NFC changes none.
_LETTERS = regex.compile(rb"(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+")

# Kinds of bytes. An apostrophe may start a part with the letters behind it, and special tokens
# stand in angle brackets, so words with these count as odd, like those with bytes beyond Latin-1.
_SPACE, _LETTER, _MARK, _DIGIT, _ODD = range(5)
_KINDS = np.full(256, _ODD, np.uint8)
_KINDS[list(b" \t\n\v\f\r")] = _SPACE
_KINDS[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = _MARK
_KINDS[np.r_[0x30:0x3A]] = _DIGIT
_KINDS[np.r_[0x41:0x5B, 0x61:0x7B]] = _LETTER
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
# Second bytes of letters in the Latin-1 block, behind 0xC3.
_LATIN = np.zeros(256, bool)
_LATIN[np.r_[0x80:0x97, 0x98:0xB7, 0xB8:0xC0]] = True


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def parts(data: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of a text cut where letters, marks and digits meet, letters lower-cased.

    Odd words stay as they are. Beside the parts the places in ``data`` where they start.
    """
    text = np.frombuffer(data, np.uint8)
    kinds = _KINDS[text]
    lead = np.flatnonzero(text[:-1] == 0xC3)
    lead = lead[_LATIN[text[lead + 1]]]
    kinds[lead] = kinds[lead + 1] = _LETTER
    lowered = _LOWER[text]
    second = lead[text[lead + 1] < 0x9F] + 1
    lowered[second] |= 0x20
    odd = np.flatnonzero(kinds == _ODD)
    if len(odd):
        spaces = np.flatnonzero(kinds == _SPACE)
        at = np.unique(np.searchsorted(spaces, odd))
        edges = np.concatenate(([-1], spaces, [len(text)]))
        turns = np.zeros(len(text) + 1, np.int8)
        turns[edges[at] + 1] = 1
        turns[edges[at + 1]] -= 1
        whole = np.flatnonzero(np.cumsum(turns[:-1], dtype=np.int8))
        kinds[whole] = _ODD
        lowered[whole] = text[whole]
    filled = kinds != _SPACE
    first = filled.copy()
    first[1:] &= kinds[1:] != kinds[:-1]
    lowered = lowered[filled]
    offsets = np.append(np.flatnonzero(first[filled]), len(lowered)).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(lowered)]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers), np.flatnonzero(first)


class LibraryIds(dict):
    """Ids of parts of words as little-endian bytes, from the tokenizers library.

    No token reaches over white space, nor from letters to marks or digits, so a text's ids are
    those of its parts in turn. Plain letters go to the library's merges alone, all others
    through its whole pipeline. The different parts of a block of texts are looked up, once each.
    """

    def __init__(self, file_text: str) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_str(file_text)
        self.model = self.tokenizer.model
        # What was known before the last time the cache was full: parts in use come back.
        self.old: dict[bytes, bytes] = {}
        shown = self.tokenizer.pre_tokenizer[1].pre_tokenize_str
        self.symbols = {
            byte: shown(bytes([0xC3, byte]).decode())[0][0][1] for byte in range(0x80, 0xC0)
        }
        self.symbols[0xC3] = shown("é")[0][0][0]

    def whole(self, part: bytes) -> bytes:
        encoding = self.tokenizer.encode(part.decode(), add_special_tokens=False)
        return packed(encoding.ids)

    def letters(self, part: bytes) -> bytes:
        text = part.decode().lower()
        if not part.isascii():
            text = text.encode().decode("latin-1").translate(self.symbols)
        return packed([token.id for token in self.model.tokenize(text)])

    def __missing__(self, part: bytes) -> bytes:
        found = self.old.get(part)
        if found is None:
            # Of bytes: A-Z and a-z only.
            plain = part.isalpha() or _LETTERS.fullmatch(part)
            found = self.letters(part) if plain else self.whole(part)
        if len(part) <= 64:
            self[part] = found
        return found

    def of(self, text: bytes) -> bytes:
        return self.all_of([text])[0].tobytes()

    def all_of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each text has."""
        found, sizes = [], np.zeros(len(texts), np.int64)
        block, owners, held = [], [], 0

        def settle() -> None:
            ids, counts = self._block(block)
            found.append(ids)
            np.add.at(sizes, owners, counts)

        for at, text in enumerate(texts):
            for piece in pieces(text):
                if block and held + len(piece) > BLOCK_BYTES:
                    settle()
                    block, owners, held = [], [], 0
                block.append(piece)
                owners.append(at)
                held += len(piece) + 1
        if block:
            settle()
        return np.concatenate(found) if found else np.zeros(0, "<i4"), sizes

    def _block(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found, starts = parts(b"\n".join(texts))
        coded = found.dictionary_encode()
        _, bounds, data = coded.dictionary.buffers()
        data = data.to_pybytes()
        bounds = np.frombuffer(bounds, np.int32, len(coded.dictionary) + 1).tolist()
        known = [self[data[low:high]] for low, high in zip(bounds, bounds[1:])]
        if len(self) > CACHED_PARTS:
            self.old = dict(self)
            self.clear()
        ends = np.cumsum([0, *map(len, known)]) // 4
        each = pa.ListArray.from_arrays(
            pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(known), "<i4"))
        )
        ids = each.take(coded.indices)
        # Where the parts of each text end.
        cuts = np.searchsorted(starts, np.cumsum([len(text) + 1 for text in texts]))
        counts = np.diff(ids.offsets.to_numpy()[cuts], prepend=0)
        return ids.values.to_numpy(), counts


def encode(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Columns ``doc_id``, ``n_tokens``, ``part``, ``offset``, ``ids``; one row per document.

    ``offset`` counts the ids before a document in its partition, in the order of the rows.
    Every document ends with ``end_id``; a NULL text is an empty one.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = with_fields(
        rows.select("doc_id").schema, "n_tokens long, part int, offset long, ids array<int>"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ("library", hash(shared.value))
        words = per_worker(key, lambda: LibraryIds(shared.value))
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, sizes = words.all_of(utf8_texts(batch.column(1)))
            ids = np.insert(ids, np.cumsum(sizes), end_id)
            sizes += 1
            ends = np.cumsum(sizes)
            ids = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids)
            )
            columns = [
                batch.column(0),
                pa.array(sizes),
                pa.array(np.full(len(sizes), part, np.int32)),
                pa.array(before + ends - sizes),
                ids,
            ]
            before += int(ends[-1]) if len(ends) else 0
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(work, schema)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_bytes: int = PART_BYTES,
) -> None:
    """Write the documents' ids in ascending order of ``doc_id``.

    Texts are spread by ranges of ``doc_id`` and encoded after that, so ids never cross the
    network. Repeated rows are written as often as they come, NULL ids first. Rows with one id
    stand in the order of the scan, and may spread over several files.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / part_bytes))
    ranged = rows.repartitionByRange(parts, "doc_id", "row").sortWithinPartitions("doc_id", "row")
    encoded = encode(ranged, tokenizer_path, end_id)
    (
        encoded.write.option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#offset", "false")
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
        .option("parquet.page.size", str(PAGE_BYTES))
        .option("compression", "zstd")
        .parquet(path)
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``start`` (ids of all documents before it). Reads no ids."""
    table = spark.read.parquet(path).select("doc_id", "n_tokens", "part", "offset")
    return _with_starts(table, table)


def _with_starts(table: DataFrame, metadata: DataFrame) -> DataFrame:
    """The start of each part is the sum of the parts before it: one row per file.

    The sums come from the metadata alone, so ids are read once at most.
    """
    sizes = metadata.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    start = (F.col("base") + F.col("offset")).alias("start")
    others = [name for name in table.columns if name not in ("part", "offset")]
    return table.join(starts, "part").select(*others, start)


def read_documents(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Documents with ids from ``first`` to ``last``; other row groups and pages are skipped."""
    return spark.read.parquet(path).where(F.col("doc_id").between(first, last))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    The checksum covers the ids as little-endian unsigned 32-bit integers.
    """
    files = spark.read.parquet(path)
    table = files.select("doc_id", "part", "offset", "ids")
    schema = with_fields(
        table.select("doc_id", "part", "offset").schema, "n_tokens long, ids_crc32 long"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            bounds = ids.offsets.to_numpy().astype(np.int64)
            data = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4"))
            data = data.cast("B")
            spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
            checks = [zlib.crc32(data[4 * low : 4 * high]) for low, high in spans]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.diff(bounds)), pa.array(checks, pa.int64())],
                schema.names,
            )

    return _with_starts(table.mapInArrow(work, schema), files.select("part", "n_tokens"))
