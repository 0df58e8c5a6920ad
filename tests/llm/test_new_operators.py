"""Merkle manifest, exact top-k search and cross-tokenizer alignment against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyworks.llm import alignment, bpe, merkle, nearest
from tallyworks.llm.queries import BYTE_BPE, PIECE_BPE, WORD_BPE


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([digest(*last[at : at + 2]) for at in range(0, len(last), 2)])
    return found


def plain_climb(levels, at):
    for level in levels[:-1]:
        other = at ^ 1
        yield (other < at, level[other]) if other < len(level) else None
        at >>= 1


def plain_manifest(rows, changed):
    """Rows are (id, lang, n, text); result rows as the operator gives them."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    langs = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda row: (row[0] is not None, row[0] or 0, plain_leaf(row)))
        trees[lang] = plain_levels([plain_leaf(row) for row in groups[lang]])
    top = plain_levels([trees[lang][-1][0] for lang in langs]) if langs else []
    for number, lang in enumerate(langs):
        for at, row in enumerate(groups[lang]):
            steps = [*plain_climb(trees[lang], at), *plain_climb(top, number)]
            shown = row
            if changed(row) and row[2] is not None:
                shown = (row[0], row[1], row[2] + 1, row[3])
            node = plain_leaf(shown)
            for step in steps:
                node = digest(node) if not step else digest(step[1], node) if step[0] else digest(node, step[1])
            proof = "".join(step[1] for step in steps if step)
            root = top[-1][0]
            yield (row[0], plain_leaf(row), trees[lang][-1][0], root, proof, node, node == root)


@pytest.mark.parametrize("height", [1, 2, 3, 10])
def test_merkle(spark, tmp_path, height):
    draw = random.Random(height)
    langs = [None, "", "en", "en", "en", "é", "zz"]
    rows = [
        (draw.choice([None, *range(60)]), draw.choice(langs), draw.choice([None, 5, 2**63 - 1]), draw.choice(["", None, "x", "naïve 🙂"]))
        for _ in range(90)
    ] + [(7, "only", 1, "one")] + [(5, "en", 1, "same")] * 9
    path = str(tmp_path / "rows")
    table = spark.createDataFrame(rows, "doc_id bigint, lang string, n bigint, text string")
    # Other columns may have names that the operator uses.
    table.selectExpr("*", "1 AS tree", "2 AS position", "'x' AS digest").repartition(3).write.parquet(path)
    built = merkle.build(
        spark.read.parquet(path),
        ["doc_id", "lang", "n", "text"],
        id_col="doc_id",
        tree_col="lang",
        changed=F.col("doc_id") % 2 == 0,
        changes={"n": F.col("n").cast("decimal(20,0)") + 1},
        block_height=height,
    )
    expected = plain_manifest(rows, lambda row: row[0] is not None and row[0] % 2 == 0)
    assert sorted(map(tuple, built.proofs().collect()), key=repr) == sorted(expected, key=repr)


def test_merkle_of_nothing_and_of_one_row(spark):
    table = spark.createDataFrame([(1, "a")], "doc_id bigint, lang string")
    built = merkle.build(table, ["doc_id"], id_col="doc_id", tree_col="lang")
    row = built.proofs().first()
    assert row.leaf == row.subroot == row.root == digest("1:1") and row.proof == "" and row.verified
    built = merkle.build(table.where("false"), ["doc_id"], id_col="doc_id", tree_col="lang")
    assert built.root is None and built.proofs().count() == 0


def test_van_emde_boas_order():
    for levels in range(1, 12):
        places = [merkle.addresses(depth, np.arange(1 << depth), levels) for depth in range(levels)]
        assert sorted(np.concatenate(places).tolist()) == list(range((1 << levels) - 1))
        if levels > 1:
            upper = levels // 2
            assert max(p.max() for p in places[:upper]) == (1 << upper) - 2
            # Each lower subtree is one stretch.
            below = (1 << levels - upper) - 1
            for root in places[upper]:
                assert (root - (1 << upper) + 1) % below == 0


def plain_top(rows, k):
    """Rows are (id, vector or None); result rows (query, rank, id, score)."""
    def numbers(vector):
        if vector is None or any(x is None or not math.isfinite(x) or abs(x * 64) >= 1 << 28 for x in vector):
            return None
        return [math.floor(64 * float(np.float32(x))) for x in vector]

    scaled = [(key, numbers(vector)) for key, vector in rows]
    scaled = [(key, vector) for key, vector in scaled if vector is not None]
    for at, (query, vector) in enumerate(scaled):
        if query is None or query % 20:
            continue
        others = sorted(
            (-sum(a * b for a, b in zip(vector, other)), key is None, key or 0)
            for place, (key, other) in enumerate(scaled)
            if place != at
        )
        for rank, (score, missing, key) in enumerate(others[:k], 1):
            yield (query, rank, None if missing else key, -score)


@pytest.mark.parametrize("sizes", [(64, 8192, 1024, 64), (3, 10, 4, 2), (1, 5, 100, 7)])
def test_top_k(spark, tmp_path, monkeypatch, sizes):
    pivots, chunk, ring, annuli = sizes
    for name, value in (("CHUNK_ROWS", chunk), ("RING", ring), ("ANNULI", annuli), ("FIRST", 1), ("QUERIES_TOGETHER", 5)):
        monkeypatch.setattr(nearest, name, value)
    draw = random.Random(3)
    def vector():
        return [float(np.float32(draw.choice([0, 0, 1, -1, draw.uniform(-1, 1)]))) for _ in range(6)]
    common = vector()
    rows = [(key, common if key % 3 == 0 else vector()) for key in range(160)]
    rows += [(20, common), (20, common), (40, vector()), (None, vector()), (None, common), (-60, vector())]
    rows += [(200, None), (220, [1.0, None, 0.0]), (240, [float("nan")] * 6), (260, [float("inf")] * 6)]
    rows += [(280, []), (300, [0.0] * 6), (320, [1.0]), (340, [1e30] * 6), (360, [3e5, -3e5] * 3)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr(
        "*", "1 AS entry", "2 AS cell", "'x' AS vector"
    ).repartition(4).write.parquet(path)
    found = nearest.top_k(spark.read.parquet(path), F.col("id") % 20 == 0, 9, pivots=pivots)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(plain_top(rows, 9), key=repr)


def test_top_k_of_few_rows(spark):
    table = spark.createDataFrame([(0, [1.0]), (20, [2.0])], "vec_id bigint, embedding array<float>")
    few = lambda part: sorted(map(tuple, nearest.top_k(part, F.col("id") % 20 == 0, 5).collect()))
    assert few(table) == [(0, 1, 20, 64 * 128), (20, 1, 0, 64 * 128)]
    assert few(table.where("vec_id = 0")) == [] and few(table.where("false")) == []


def test_rings_are_left_out():
    """Entries of a far cluster are never looked at, and the result is that of a full scan."""
    draw = np.random.default_rng(1)
    near = draw.integers(-3, 4, (50, 8)) + np.array([100] + [0] * 7)
    far = draw.integers(-3, 4, (50, 8)) + np.array([-100] + [0] * 7)
    entries = np.concatenate([near, far]).astype(float)
    sphere = nearest.Sphere.of(entries[:10], int((entries**2).sum(axis=1).max()), 1)
    angles = sphere.of_entries(entries)[:, 0]
    order = np.argsort(angles)
    entries, angles = entries[order], angles[order]
    seen = []
    exact = nearest.products
    try:
        nearest.RING, ring = 10, nearest.RING
        nearest.products = lambda a, b: seen.append(len(b)) or exact(a, b)
        query = near[:1].astype(float)
        found = nearest.search_chunk(
            sphere, entries, [[at] for at in range(100)], angles, query, sphere.of_queries(query)[:, 0],
            np.array([-(2**62)]), 5,
        )
    finally:
        nearest.RING, nearest.products = ring, exact
    scores = exact(query, entries)[0]
    best = sorted(range(100), key=lambda at: (-scores[at], at))[:5]
    assert found[2].tolist() == best and sum(seen) <= 50


@pytest.fixture(scope="module")
def tokenizers():
    first = Tokenizer.from_file(BYTE_BPE)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


def plain_groups(tokenizers, text):
    first, second = tokenizers
    if not text:
        return [], [], []
    byte_of = {symbol: byte for byte, symbol in enumerate(bpe.byte_symbols())}
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    in_a = [bytes(byte_of[c] for c in first.id_to_token(one)) for one in a]
    pieces = [(one, second.id_to_piece(one)) for one in b]
    in_b = [
        bytes([int(piece[3:5], 16)]) if second.is_byte(one) else piece.replace("▁", " ").encode()
        for one, piece in pieces
    ]
    if b"".join(in_a) != (" " + text).encode() or b"".join(in_b) != (" " + text).encode():
        return [], [], []
    ends_a, ends_b = (np.cumsum(list(map(len, parts))).tolist() for parts in (in_a, in_b))
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        k, m = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append((a[i:k], b[j:m]))
        i, j = k, m
    return a, b, groups


TEXTS = [
    None, "", " ", "  a  b ", "<|endoftext|> <s> </s> <unk>", "x▁y", "x" * 3000, "word " * 50, "don't you've",
    "日本語 🙂 été  don't\n\n a b  　 c\r\n{\r d", "\x00 a\x85 b\x1c c\t d ", "1234567 89 " + "ab" * 500 + " İ ẞ",
    "naïve Über façade ©2024 — “quoted”", "naïve Über façade ©2024 — “quoted”", "the cat sat on the mat",
]


@pytest.mark.parametrize("chunk", [1 << 20, 40])
def test_alignment(spark, tmp_path, monkeypatch, tokenizers, chunk):
    monkeypatch.setattr(alignment, "CHUNK_PAIRS", chunk)
    rows = [(at % 9 or None, text) for at, text in enumerate(TEXTS)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "1 AS chunk", "2 AS place", "'x' AS groups", "3 AS id"
    ).repartition(4).write.parquet(path)
    found, pairs = alignment.align(spark.read.parquet(path), BYTE_BPE, PIECE_BPE)
    plain = [(key, plain_groups(tokenizers, text)) for key, text in rows]
    linked = [Counter((x, y) for a, b in groups for x in a for y in b) for _, (_, _, groups) in plain]
    held = Counter(pair for links in linked for pair in links)
    most = {}
    for (a, _), count in held.items():
        most[a] = max(most.get(a, 0), count)
    expected = []
    for (key, (a, b, groups)), links in zip(plain, linked):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        best = sum(n for pair, n in links.items() if held[pair] == most[pair[0]])
        total = sum(n * held[pair] for pair, n in links.items())
        hashed = hashlib.sha256(text.encode()).hexdigest() if a else ""
        expected.append((key, len(a), len(b), len(groups), sum(links.values()), best, total, hashed))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert {(r.a, r.b): r.documents for r in pairs.collect()} == held


def test_alignment_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    found, pairs = alignment.align(none, BYTE_BPE, PIECE_BPE)
    assert found.count() == 0 and pairs.count() == 0


def test_galloping_finds_common_ends():
    draw = random.Random(7)
    for _ in range(200):
        words = []
        for _ in range(draw.randint(1, 5)):
            size = draw.randint(1, 60)
            words.append([sorted({*draw.sample(range(1, size + 1), draw.randint(0, size)), size}) for _ in "ab"])
        base, lists, expected = 0, ([], []), set()
        for both in words:
            for ends, found in zip(both, lists):
                found += [base + end for end in ends]
            expected |= {base + end for end in set(both[0]) & set(both[1])}
            base += both[0][-1]
        sizes = (np.array([len(both[side]) for both in words]) for side in (0, 1))
        a, b = alignment.common_ends(np.array(lists[0]), np.array(lists[1]), *sizes)
        assert [lists[0][at] for at in a] == [lists[1][at] for at in b] == sorted(expected)


def test_bpe_over_all_code_points():
    library = Tokenizer.from_file(WORD_BPE)
    words = bpe.WordIds(bpe.Vocabulary(bpe.read_vocabulary(WORD_BPE)))
    points = [point for point in range(0x110000) if not 0xD800 <= point < 0xE000 and point < 0x34000]
    for start in range(0, len(points), 50_000):
        texts = [f"A{chr(point)}́b {chr(point)}1" for point in points[start : start + 50_000]]
        expected = [each.ids for each in library.encode_batch_fast(texts, add_special_tokens=False)]
        flat, sizes = words.ids([text.encode() for text in texts])
        found = [ids.tolist() for ids in np.split(flat, np.cumsum(sizes)[:-1])]
        assert found == expected


def test_bpe_of_long_words():
    library = Tokenizer.from_file(WORD_BPE)
    words = bpe.WordIds(bpe.Vocabulary(bpe.read_vocabulary(WORD_BPE)))
    draw = random.Random(1)
    for size in (1, 2, 63, 64, 65, 511, 512, 513, 5000):
        text = "".join(draw.choices("abcdeinrst", k=size))
        assert words.of(text.encode()) == library.encode(text, add_special_tokens=False).ids


def test_changed_rows_are_those_the_checksum_names(spark):
    ids = list(range(50))
    table = spark.createDataFrame([(one,) for one in ids], "doc_id bigint")
    named = table.where(F.crc32(F.col("doc_id").cast("string")) % 7 == 0).collect()
    assert sorted(row.doc_id for row in named) == [one for one in ids if zlib.crc32(str(one).encode()) % 7 == 0]
