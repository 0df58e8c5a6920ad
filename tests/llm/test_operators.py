"""Every operator against a plain computation, on odd texts and on empty tables."""

import collections
import hashlib
import math
import random
import zlib

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyworks.llm import (
    bpe,
    decontaminate,
    languages,
    licenses,
    pii,
    pst,
    simhash,
    spotsigs,
    suffixes,
    tokenfiles,
)
from tallyworks.llm.components import components
from tallyworks.llm.queries import WORD_BPE
from tallyworks.session import work_path
from tests.llm.conftest import TEXTS


@pytest.fixture(scope="module")
def texts(odd):
    return [(row.doc_id, row.text) for row in odd.select("doc_id", "text").collect()]


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(shingle, 42) for shingle in shingles]
    bits = (sum(h >> bit & 1 for h in hashes) * 2 > len(hashes) for bit in range(64))
    return sum(1 << bit for bit, is_set in enumerate(bits) if is_set)


def test_simhash(odd, texts, empty):
    got = simhash.near_duplicates(odd).select("id", simhash.hexadecimal("fingerprint"), "component")
    expected = [(key, f"{plain_fingerprint(text):016x}") for key, text in texts]
    prints = {}
    for key, value in expected:
        prints.setdefault(value, []).append(key)
    found = [(r[0], r[1]) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    by_id = {r[0]: r[2] for r in got.collect()}
    assert by_id[2] == 1 and by_id[3] == by_id[4] == by_id[5] == 3
    assert simhash.near_duplicates(empty).count() == 0


def test_links_are_all_pairs_within_the_distance(spark):
    draw = random.Random(5)
    centres = [draw.getrandbits(64) for _ in range(20)]
    values = set()
    for centre in centres:
        for _ in range(12):
            value = centre
            for bit in draw.sample(range(64), draw.randint(0, 4)):
                value ^= 1 << bit
            values.add(value - (1 << 64) if value >> 63 else value)
    values = sorted(values)
    nodes = spark.createDataFrame(list(enumerate(values)), "id bigint, fingerprint bigint")
    for bits in (0, 1, 2, 3):
        expected = {
            (a, b)
            for a, x in enumerate(values)
            for b, y in enumerate(values)
            if a < b and ((x ^ y) & (1 << 64) - 1).bit_count() <= bits
        }
        got = {tuple(sorted(pair)) for pair in simhash.links(nodes, bits).collect()}
        assert got == expected


def test_components(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(50, 40), (50, 60), (7, 7), (80, 81)]
    random.Random(1).shuffle(pairs)
    got = dict(components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect())
    expected = dict.fromkeys(range(31), 0) | dict.fromkeys((40, 50, 60), 40) | {80: 80, 81: 80}
    assert got == expected


def plain_repeats(texts, length):
    data = [(text or "").encode() for text in texts]
    counts = collections.Counter(
        text[at : at + length] for text in data for at in range(len(text) - length + 1)
    )
    for text in data:
        removed = bytearray(len(text))
        for at in range(len(text) - length + 1):
            if counts[text[at : at + length]] > 1:
                removed[at : at + length] = b"\1" * length
        yield bytes(byte for byte, gone in zip(text, removed) if not gone)


def test_repeats(odd, texts, empty, spark):
    got = suffixes.remove_repeats(odd, length=70)
    expected = list(plain_repeats([text for _, text in texts], 70))
    kept = [bytes(r.kept) for r in got.collect()]
    assert sorted(kept) == sorted(expected)
    assert suffixes.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("together", [2048, 2])
def test_repeats_in_random_texts(spark, tmp_path, monkeypatch, together):
    monkeypatch.setattr(suffixes, "SORTED_TOGETHER", together)
    draw = random.Random(9)
    common = ["".join(draw.choices("ab c", k=draw.randint(60, 300))) for _ in range(6)]
    made = [
        "".join(
            draw.choice([*common, "".join(draw.choices("xyzé ", k=draw.randint(1, 90)))])
            for _ in range(draw.randint(0, 9))
        )
        for _ in range(60)
    ]
    made += [made[3]] * 3
    path = str(tmp_path / "texts")
    spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string").write.parquet(path)
    got = {r.id: bytes(r.kept) for r in suffixes.remove_repeats(spark.read.parquet(path), length=200).collect()}
    assert [got[at] for at in range(len(made))] == list(plain_repeats(made, 200))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


def test_token_files(spark, odd, texts, empty, library):
    path = work_path(spark, "test-tokens")
    tokenfiles.write_tokens(odd, path, WORD_BPE, 2, part_bytes=20_000)
    got = sorted(map(tuple, tokenfiles.read_digests(spark, path).collect()), key=repr)
    plain = []
    for key, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        plain.append((key, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
    names = tokenfiles.read_digests(spark, path).columns
    place = [names.index(name) for name in ("doc_id", "n_tokens", "ids_crc32", "start")]
    found = [tuple(row[at] for at in place) for row in got]
    assert sorted((row[:3] for row in found), key=repr) == sorted(plain, key=repr)
    before = 0
    for row in sorted(found, key=lambda row: row[3]):
        assert row[3] == before
        before += row[1]
    ordered = [row[0] for row in sorted(found, key=lambda row: row[3])]
    assert ordered[0] is None and ordered[1:] == sorted(ordered[1:])
    assert tokenfiles.read_documents(spark, path, 6, 8).count() == 3
    assert tokenfiles.read_metadata(spark, path).count() == len(texts)
    nothing = work_path(spark, "test-tokens")
    tokenfiles.write_tokens(empty, nothing, WORD_BPE, 2)
    assert tokenfiles.read_digests(spark, nothing).count() == 0


def test_bpe(odd, texts, empty, library):
    encoded = bpe.decode(bpe.encode(odd, WORD_BPE), WORD_BPE)
    both = bpe.encode(odd, WORD_BPE, decoded="decoded")
    assert sorted(map(str, both.collect())) == sorted(map(str, encoded.collect()))
    assert encoded.columns[: len(odd.columns)] == odd.columns
    expected = []
    for _, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted((r.ids, r.decoded) for r in encoded.collect()) == sorted(expected)
    assert bpe.encode(empty, WORD_BPE).count() == 0
    assert bpe.digests(odd, WORD_BPE).count() == len(texts)


def test_bpe_on_random_words(library):
    words = bpe.WordIds(bpe.Vocabulary(bpe.read_vocabulary(WORD_BPE)))
    ids = tokenfiles.LibraryIds(bpe.read_vocabulary(WORD_BPE))
    draw = random.Random(2)
    letters = "ab'sS tT.…é́≠<|endoftext|>̀  \x85\x1c\x0bßİΣςK1٣²ǅ가ᄀ"
    for _ in range(3000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 14)))
        expected = library.encode(text, add_special_tokens=False).ids
        assert words.of(text.encode()) == expected
        assert ids.of(text.encode()) == b"".join(i.to_bytes(4, "little") for i in expected)


def test_token_parts_are_looked_up_once(library):
    """Case, marks and digits beside a word make no new word of it."""
    ids = tokenfiles.LibraryIds(bpe.read_vocabulary(WORD_BPE))
    asked, letters, whole = [], ids.letters, ids.whole
    ids.letters = lambda part: asked.append(part) or letters(part)
    ids.whole = lambda part: asked.append(part) or whole(part)
    texts = ["The the, THE. (the) the-the the12the", "", "Été été! ÉTÉ ß ×the don't", "the <|endoftext|>THE"]
    found, sizes = ids.all_of([text.encode() for text in texts])
    expected = [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert sizes.tolist() == list(map(len, expected))
    assert found.tolist() == sum(expected, [])
    assert len(asked) == len(set(asked))
    assert [part for part in asked if b"the" in part.lower()] == [b"the", "×the".encode(), b"<|endoftext|>THE"]


def test_personal_data(odd, texts, empty):
    found = pii.detect(odd)
    spans = {r.doc_id: r.spans for r in found.collect()}
    text = dict(texts)[10]
    taken = [(s.kind, text[s.start : s.end]) for s in spans[10] if s.base]
    assert taken == [
        ("email", "joe.doe@example.com"),
        ("card", "4111 1111 1111 1111"),
        ("phone", "+1 (988) 555-2485"),
    ]
    assert all(not spans[key] for key in (1, 3, 4, 6, 8))
    masked = {r.doc_id: r.text for r in pii.masked(odd).collect()}
    assert masked[10] == "Mail me: <email> or <phone>, card <card>."
    assert masked[3] is None and masked[1] == dict(texts)[1]
    assert pii.detect(empty).count() == 0


def test_long_personal_data_is_taken_to_its_end(spark):
    secret, local, host = "aB3" * 100, "joe.doe_" * 20, "h0-" * 50 + "st"
    texts = [
        (1, f"set token={secret} here"),
        (2, f"write to {local}x (at) {host}.a.b (dot) c . d . e.com, or call"),
        (3, "a (at) b.c_d[at]e.f and (at) g.h, i(at)j.k(at)l.m, n (at) o"),
        (4, "a" * 300_000 + " (at) " * 50_000 + "token=" * 50_000),
    ]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = {key: [text[s.start : s.end] for s in pii.propose(text)] for key, text in texts}
    assert found[1] == [secret]
    assert found[2] == [texts[1][1][9:-9]]
    assert found[3] == ["a (at) b.c", "_d[at]e.f", "and (at) g.h", "i(at)j.k"]
    assert found[4] == []
    masked = {r.doc_id: r.text for r in pii.masked(docs.where("doc_id = 1")).collect()}
    assert masked[1] == "set token=<secret> here"


def test_labelers_that_agree_are_trusted():
    draw = random.Random(4)
    counts = collections.Counter()
    for _ in range(4000):
        real = draw.random() < 0.4
        votes = [
            (1 if real else -1) if draw.random() < right else 0 if draw.random() < 0.5 else
            (-1 if real else 1)
            for right in (0.95, 0.9, 0.85, 0.4)
        ]
        counts[pii._cell("phone", tuple(votes), 5 if real else 1)] += 1
    scores = pii.train(counts)
    assert scores[pii._cell("phone", (1, 1, 1, 0), 5)] > 0.9
    assert scores[pii._cell("phone", (-1, -1, -1, 0), 1)] < 0.1
    assert set(pii.train({}).values()) == {0.0}


def test_suffix_tree_scores(odd, texts, empty):
    got = pst.score(odd, ~pst.held_out(F.col("doc_id"))).collect()
    held = [zlib.crc32(str(key if key is not None else "").encode()) % 7 == 2 for key, _ in texts]
    counts, ends = collections.Counter(), 0
    for (_, text), out in zip(texts, held):
        if not out:
            counts.update((text or "").encode().lower().split())
            ends += 1
    counts["end"] = ends
    total, kinds = sum(counts.values()), len(counts)
    expected = []
    for (key, text), out in zip(texts, held):
        tokens = [*(text or "").encode().lower().split(), "end"]
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens)
        known = sum(counts[t] > 0 for t in tokens)
        expected.append((key, not out, len(tokens), known, total, round(base, 6)))
    found = [
        (r.id, r.trains, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in got
    ]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)
    assert pst.score(empty, F.lit(True)).count() == 0


def test_suffix_tree_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scored = pst.score(docs, ~pst.held_out(F.col("doc_id"))).where("NOT trains")
    score, base = scored.agg(F.sum("score"), F.sum("base_score")).first()
    assert score > base


def plain_tree_scores(texts, trains):
    """Scores by the definition, with runs of words as tuples."""
    tokens = [[*(text or "").encode().lower().split(), "end"] for text in texts]
    counts = [collections.Counter() for _ in range(pst.DEPTH + 1)]
    words = collections.Counter(t for row, train in zip(tokens, trains) if train for t in row)
    ends = sum(trains)
    kinds = len(words) - (ends > 0)
    new = max(1, kinds)
    runs, sizes = collections.Counter(), collections.Counter()
    for row, train in zip(tokens, trains):
        padded = ["end"] * pst.DEPTH + row
        for at in range(pst.DEPTH, len(padded)):
            for depth in range(1, pst.DEPTH + 1):
                runs[tuple(padded[at - depth : at + 1])] += train
                sizes[tuple(padded[at - depth : at])] += train

    def smoothed(run, shorter):
        size = sizes[run[:-1]]
        weight = pst.SMOOTHING * size**pst.GROWTH
        return (runs[run] + weight * shorter) / (size + weight)

    kept = set()

    def chance(run):
        if len(run) == 1:
            return (words[run[0]] or new) / (sum(words.values()) + new)
        shorter = chance(run[1:])
        return smoothed(run, shorter) if run[:-1] in kept else shorter

    for depth in range(1, pst.DEPTH + 1):
        gains = collections.Counter()
        for run, n in runs.items():
            if len(run) == depth + 1 and n and sizes[run[:-1]] >= pst.LEAST_COUNT:
                shorter = chance(run[1:])
                gains[run[:-1]] += n * math.log2(smoothed(run, shorter) / shorter)
        kept |= {run for run, gain in gains.items() if gain >= pst.LEAST_DIVERGENCE}
    scores = []
    for row in tokens:
        padded = ["end"] * pst.DEPTH + row
        each = [tuple(padded[at : at + pst.DEPTH + 1]) for at in range(len(row))]
        scores.append(sum(math.log10(chance(run)) for run in each))
    return scores, kept


def test_every_word_is_a_symbol_of_the_suffix_tree(spark, tmp_path, monkeypatch):
    draw = random.Random(11)
    # Pairs of rare words that stand together, far beyond 254 words, and a frequent word.
    pairs = [(f"left{i}", f"right{i}", f"Third{i}") for i in range(500)]
    texts = [
        " ".join(" ".join(draw.choice(pairs)) + " the" * draw.randrange(3) for _ in range(40))
        for _ in range(300)
    ]
    texts += [None, "", "left1 right1 never right2", "the the the"]
    trains = [at % 7 != 2 for at in range(len(texts))]
    path = str(tmp_path / "docs")
    rows = [(at, text, train) for at, (text, train) in enumerate(zip(texts, trains))]
    spark.createDataFrame(rows, "doc_id long, text string, learn boolean").coalesce(1).write.parquet(path)
    # Many chunks and buckets, so that contexts meet from several chunks, and "the" is spread.
    monkeypatch.setattr(pst, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(pst, "BUCKET_BYTES", 10_000)
    found = pst.score(spark.read.parquet(path), F.col("learn")).collect()
    expected, kept = plain_tree_scores(texts, trains)
    assert {len(run) for run in kept} >= {1, 2} and len(kept) > 500
    got = {r.id: r.score for r in found}
    assert all(math.isclose(got[at], want, rel_tol=1e-6) for at, want in enumerate(expected))
    # A rare word foretells the next one.
    assert got[302] > -16 and len(got) == len(texts)


def test_suffix_tree_takes_the_texts_once_for_all_depths(spark, tmp_path, monkeypatch):
    draw = random.Random(12)
    # Nearly all contexts are too frequent for a bucket, by one word and by two.
    texts = [
        " ".join(draw.choice(["a b", "b a", "The", f"w{draw.randrange(300)}"]) for _ in range(60))
        for _ in range(200)
    ]
    texts += [None, "", "b a END end a b", "The a"]
    trains = [at % 5 != 2 for at in range(len(texts))]
    path = str(tmp_path / "docs")
    rows = [(at, text, train) for at, (text, train) in enumerate(zip(texts, trains))]
    spark.createDataFrame(rows, "doc_id long, text string, learn boolean").coalesce(1).write.parquet(path)
    monkeypatch.setattr(pst, "CHUNK_BYTES", 3_000)
    monkeypatch.setattr(pst, "BUCKET_BYTES", 2_000)
    monkeypatch.setattr(pst, "SAMPLE_BYTES", 1, raising=False)
    monkeypatch.setattr(pst, "SAMPLE_PART", 0.3, raising=False)
    found = pst.score(spark.read.parquet(path), F.col("learn"))
    # What is scored last is sums by text: the texts are not dealt out again.
    assert found.inputFiles() and not any(path in file for file in found.inputFiles())
    expected, _ = plain_tree_scores(texts, trains)
    got = {r.id: r.score for r in found.collect()}
    assert len(got) == len(texts)
    assert all(math.isclose(got[at], want, rel_tol=1e-6) for at, want in enumerate(expected))


def test_packed_columns_come_back():
    import numpy as np

    columns = [np.arange(n) * factor for n in (0, 1, 5, 5000) for factor in (0, 1, 1 << 40)]
    back = pst._unpack(pst._pack(*columns))
    assert all((one == other).all() and len(one) == len(other) for one, other in zip(columns, back))


def test_states_are_the_longest_kept_suffix():
    import numpy as np

    draw = random.Random(3)
    data = bytes(draw.choice((2, 3)) if i % 2 else 4 for i in range(4000))
    codes, counts = np.unique(pst.grams([data]), return_counts=True)
    entries, sums = [], []
    for depth in range(pst.DEPTH + 1):
        cut = codes & np.uint32((1 << 8 * (depth + 1)) - 1)
        found, back = np.unique(cut, return_inverse=True)
        entries.append(found)
        sums.append(np.bincount(back, counts).astype(float))
    tree = pst.build(entries, sums, len(data))
    every = np.array([(4 << 8 | 2) << 8 | s for s in range(256)], np.uint32)
    chances = tree.probability(every)
    assert abs(chances.sum() - 1) < 1e-9 and chances[4] > 0.99


def test_spotsigs(odd, texts, empty, spark):
    got = spotsigs.edited_pairs(odd).collect()
    order = sorted(range(len(texts)), key=lambda at: (texts[at][0] is not None, texts[at][0] or 0))
    expected = []
    for place, at in enumerate(order):
        mine, following = texts[at][1] or "", texts[order[(place + 1) % len(order)]][1] or ""
        half = len(mine) // 2
        edited = mine[: len(mine) - half] + following[:half]
        expected.append((texts[at][0], len(mine), hashlib.sha256(edited.encode()).hexdigest()))
    found = [(r.id, r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest()) for r in got]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by_id = {r.id: r for r in got}
    assert by_id[1].own == by_id[2].own and by_id[1].near_next == 1
    assert by_id[3].own == [] and len(by_id[6].own) == 1
    assert spotsigs.edited_pairs(empty).count() == 0


def test_similar_sets_lose_no_link(spark):
    draw = random.Random(8)
    words = ["the", "of", "and"] + [f"w{i}" for i in range(40)]
    base = [[draw.choice(words) for _ in range(60)] for _ in range(8)]
    made = []
    for text in base:
        for edits in (0, 0, 1, 2, 5):
            other = list(text)
            for _ in range(edits):
                other[draw.randrange(60)] = draw.choice(words)
            made.append(" ".join(other))
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string")
    sets = {
        r.doc_id: frozenset(r.s)
        for r in spotsigs.with_signatures(docs, "text", "s").select("doc_id", "s").collect()
    }
    members, pairs = spotsigs.similar(docs, least=0.8)
    members = dict(members.collect())
    assert members == {k: min(o for o in sets if sets[o] == sets[k]) for k in sets}
    classes = sorted(set(members.values()))
    expected = {
        (a, b)
        for a in classes
        for b in classes
        if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9
    }
    assert {(r.a, r.b) for r in pairs.collect()} == expected and expected


ITEM = "A train leaves the station at 9 with 40 seats and then 40 people from Paris board the slow train quickly"


def test_decontamination(spark, tmp_path, empty):
    other = ITEM.replace("40", "75").replace("9", "11").replace("Paris", "Rome")
    broken = ITEM.replace("40", "75", 1)
    rows = [
        (1, "Some words before. " + ITEM + " and words after it."),
        (2, "Other figures: " + other),
        (3, "One slot differs: " + broken),
        (4, "Nothing of it is here at all, no train."),
        (5, None),
        (6, ""),
        (7, "the station at 9 with 40 seats"),
        (None, ITEM),
    ]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    items = spark.createDataFrame(
        [(1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "no such question anywhere")],
        "item_id bigint, text string",
    )
    got = {r.id: (r.item, r.changed) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {1: (1, False), 2: (1, True), None: (1, False)}
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.contaminated(docs, items.where("false")).count() == 0


def found_in(spark, tmp_path, texts, items):
    """What is found: (document, item) -> row."""
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(
        1
    ).write.parquet(path)
    items = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = decontaminate.contaminated(spark.read.parquet(path), items).collect()
    assert len(got) == len({(r.id, r.item) for r in got})
    return {(r.id, r.item): r for r in got}


def test_copies_are_found_whatever_their_case_and_slots(spark, tmp_path):
    items = [
        "What is 12 + 30 * 4 - 6 / 2",
        "the row reads 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 and then it ends",
        "when the old Arthur met, on a road to Rome, young Bertha, then both went by Lyon home",
        "add 2 and 3",
    ]
    texts = [*items, items[2].lower(), items[2].upper(), "so: " + items[0].lower(),
             items[0].replace("12", "13"), items[3].replace("3", "4").upper()]
    got = found_in(spark, tmp_path, texts, items)
    assert {key: r.changed for key, r in got.items()} == {
        (0, 0): False, (1, 1): False, (2, 2): False, (3, 3): False,
        (4, 2): False, (5, 2): False, (6, 0): False, (7, 0): True, (8, 3): True,
    }
    assert all(got[at].share == 1 for at in got)


def test_places_of_an_item_count_once(spark, tmp_path):
    words = [f"word{chr(97 + at)}" for at in range(24)]
    item, line = " ".join(words[:20]), " ".join(words[:8])
    texts = [
        ". ".join(["rubric " + line] * 7),
        " ".join([*words[:8], "other", *words[9:17], "other", *words[18:20]]),
        " ".join([*words[:9], "cut", "here", *words[3:14]]),
        " ".join([*words[:13], "and", "others"]),
    ]
    got = found_in(spark, tmp_path, texts, [item])
    assert {key: (r.windows, r.longest, r.share) for key, r in got.items()} == {
        (3, 0): (6, 13, 6 / 13)
    }
    longer = [" ".join([*words[:10], "cut", "here", *words[3:15]])]
    got = found_in(spark, tmp_path / "longer", longer, [item])
    assert (got[0, 0].windows, got[0, 0].longest, got[0, 0].share) == (8, 12, 8 / 13)


def test_a_contradiction_does_not_drop_a_copy(spark, tmp_path):
    words = [f"word{chr(97 + at // 26)}{chr(97 + at % 26)}" for at in range(60)]
    words[5] = words[35] = words[50] = "40"
    item = " ".join(words)
    typo = " ".join([*words[:35], "41", *words[36:]])
    middle = " ".join([*words[:5], "7", *words[6:35], "8", *words[36:50], "7", *words[51:]])
    pears = "he buys 3 red apples and 5 green pears from the old man there"
    both = pears.replace("3", "4").replace("5", "4")
    torn = " ".join([*words[:11], "x", *words[12:18], "x", *words[19:29], "x"])
    got = found_in(spark, tmp_path, [typo, middle, both, torn], [item, pears])
    assert {key: r.changed for key, r in got.items()} == {
        (0, 0): True, (1, 0): True, (2, 1): True
    }
    assert (got[0, 0].windows, got[0, 0].longest) == (37, 44)
    assert (got[1, 0].windows, got[1, 0].longest) == (37, 44)
    assert (got[2, 1].windows, got[2, 1].longest, got[2, 1].share) == (7, 14, 1)


def test_pieces_are_all_longest_consistent_stretches(spark):
    draw = random.Random(6)
    rows, expected = [], {}
    for row in range(40):
        theirs = [draw.choice("1234") for _ in range(14)]
        mine = [draw.choice("789") if draw.random() < 0.3 else value for value in theirs]
        slots = [(at, t, m, t != m) for at, (t, m) in enumerate(zip(theirs, mine))]
        rows.append((row, row, 0, 0, 0, 12, 3, 12, slots))

        def holds(low, high):
            return len(set(zip(theirs[low:high], mine[low:high]))) == len(set(theirs[low:high]))

        spans = [(a, b) for a in range(14) for b in range(a + 3, 15) if holds(a, b)]
        expected[row] = max((b - a for a, b in spans), default=0)
    kind = "array<struct<at: int, theirs: string, mine: string, changed: boolean>>"
    runs = spark.createDataFrame(
        rows,
        "row long, id long, item long, shift int, first int, n int, size int, `all` int, "
        f"slots {kind}",
    )
    pieces = decontaminate._consistent(runs).collect()
    found = dict.fromkeys(expected, 0)
    for piece in pieces:
        words = slice(piece.first, piece.first + piece.n + piece.size - 1)
        pairs = {(slot[1], slot[2]) for slot in rows[piece.row][-1][words]}
        assert len(pairs) == len({theirs for theirs, _ in pairs})
        assert piece.changed == any(theirs != mine for theirs, mine in pairs)
        found[piece.row] = max(found[piece.row], piece.n + piece.size - 1)
    assert found == expected
    best = collections.Counter(piece.row for piece in pieces if piece.best)
    assert best == {row: 1 for row, longest in expected.items() if longest}


def test_licences(odd, empty, spark):
    texts = [
        (1, "The MIT License. mit-license! Apache License, general public license"),
        (2, "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0"),
        (3, "permit license, mit licenses"),
        (4, "Licensed under CC BY-NC 4.0."),
    ]
    got = {r.id: r for r in licenses.scan(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word) == (10, 4, 1, 7)
    assert got[1].base_labels == ["apache", "gpl", "mit"]
    assert got[2].labels == ["apache", "gpl", "mit"] and got[2].base_labels == []
    assert (got[3].n_base, got[3].first_word, got[3].labels, got[3].score) == (0, None, [], 0.0)
    assert got[4].labels == ["cc-by-nc"]
    assert licenses.scan(odd).count() == len(TEXTS) and licenses.scan(empty).count() == 0


@pytest.mark.parametrize(
    "expression, expected",
    [
        ("MIT OR Apache-2.0 AND BSD-3-Clause", "mit apache-2.0 bsd-3-clause and or"),
        ("(MIT or GPL-2.0) and ISC", "mit gpl-2.0 or isc and"),
        ("GPL-2.0 WITH x AND MIT", "gpl-2.0 x with mit and"),
        ("MIT OR", "mit"),
        ("MIT) AND GPL", "mit"),
        ("AND MIT", ""),
        ("", ""),
        ("MIT Apache", "mit"),
    ],
)
def test_expressions(expression, expected):
    assert " ".join(licenses.postfix(expression)) == expected


def test_languages(odd, empty, spark):
    learned = languages.prototypes(odd, "text", "lang")
    found = {r.doc_id: (r.lang_pred, r.score) for r in languages.identify(odd, learned).collect()}
    assert found[3] == found[4] == found[5] == ("und", 0.0)
    assert found[12][0] == "de" and found[13][0] == "fr"
    assert all(0 <= score <= 1 for _, score in found.values())
    assert languages.identify(empty, learned).count() == 0
    assert languages.prototypes(empty, "text", "lang") == {}
    nothing = languages.identify(odd, {})
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = languages.identify(docs, languages.learn(docs)).where(languages.held_out(F.col("doc_id")))
    right, count = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert right >= 0.95 * count


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    letters = languages.Letters(64, 1)
    text = "one two, THREE ünd vier " * 50
    whole = letters.trigrams(text)
    monkeypatch.setattr(languages, "_PIECE", 7)
    cut = letters.trigrams(text)
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist()
    data = (" ".join(f"w{i % 97}" for i in range(4000))).encode()
    whole = simhash.fingerprint(data, 3)
    monkeypatch.setattr(simhash, "pieces", lambda text: __import__(
        "tallyworks.llm.common", fromlist=["pieces"]).pieces(text, 50))
    assert simhash.fingerprint(data, 3) == whole
