"""Every corpus operator on odd input (nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables)
and against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adpulse.llm import common, minhash, quality, tokens, toxicity
from adpulse.llm.components import components
from adpulse.llm.decontaminate import Index, Settings, drop_leaking, find_leaks
from adpulse.llm.exact import deduplicate_exact
from adpulse.llm.lines import deduplicate_lines
from adpulse.llm.minhash import drop_near_duplicates, near_duplicates
from adpulse.llm.order import manifest, permute, write_in_training_order
from adpulse.llm.packing import pack_documents, plan_packing
from adpulse.llm.quality import ArrayPool, TablePool, co_train, fit_quality, keep_quality, quality_features, score_features, score_quality
from adpulse.llm.queries import tokenizer_path
from adpulse.llm.substring import deduplicate_substrings
from adpulse.llm.tokens import WordTokenizer
from adpulse.llm.toxicity import Lexicon, ToxicityModel, clause_weight, score_toxicity
from adpulse.llm.urls import judge_urls, site_rule

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_key string, line int"
_random = random.Random(7)
WORDS = ["w%d" % n for n in range(400)]
PASSAGE = " ".join(_random.choices(WORDS, k=30))
LONG = " ".join(_random.choices(WORDS, k=30_000))
BODY = " ".join(_random.choices(WORDS, k=80))
ROWS = [
    (1, PASSAGE + " tail one", "en", "a", 10, "x", 1),
    (2, "head " + PASSAGE, "en", "a", 10, "x", 1),
    (3, None, None, None, None, None, None),
    (4, "", "en", "a", 0, "x", 1),
    (5, BODY, "en", "a", 10, "x", 1),
    (5, BODY, "en", "a", 10, "x", 1),
    (6, BODY + " more", "en", "a", 10, "x", 1),
    (7, LONG, "en", "a", 10, "x", 1),
    (None, BODY, "en", "a", 10, "x", 1),
    (8, " \n\t ", "en", "a", 10, "x", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_substrings(docs, nothing):
    rows = deduplicate_substrings(docs).collect()
    by = {(row["doc_id"], row["n_words"]): row for row in rows}
    assert len(rows) == len(ROWS)
    assert by[1, 32]["n_removed"] == 0 and by[2, 31]["n_removed"] == 30 and by[2, 31]["kept_text"] == "head"
    # Rows alike keep their words; the next ids lose them, and rows without an id come last.
    assert by[5, 80]["n_removed"] == 0 and by[6, 81]["kept_text"] == "more" and by[None, 80]["n_removed"] == 80
    assert by[3, 0]["kept_sha256"] == by[4, 0]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert deduplicate_substrings(nothing).count() == 0


def test_lines(spark, docs, nothing):
    long_line, short = "x" * 70, "short"
    texts = [(1, f"{long_line}\n{short}\nend"), (2, f"{short}\n\n{long_line}"), (3, "\n".join([short] * 14)), (4, None), (5, "")]
    rows = {r["doc_id"]: r for r in deduplicate_lines(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert rows[1]["lines_removed"] == 0
    assert rows[2]["text"] == f"{short}\n" and rows[2]["lines_removed"] == 1
    # Twelve short lines make a run; the copy that overlaps the first goes but for the lines of the first alone.
    assert rows[3]["lines_removed"] == 13 and rows[3]["text"] == short
    assert rows[4]["text"] is None and rows[5]["text"] == ""
    kept = deduplicate_lines(docs)
    assert kept.columns == [*docs.columns, "lines_before", "lines_removed"] and kept.count() == len(ROWS)
    assert deduplicate_lines(nothing).count() == 0


def test_exact(spark, docs, nothing, tmp_path):
    path, empty = str(tmp_path / "documents.parquet"), str(tmp_path / "none.parquet")
    docs.repartition(3).write.parquet(path)
    nothing.write.parquet(empty)
    for digest in (lambda c: F.sha2(c, 256), lambda c: F.substring(F.sha2(c, 256), 1, 1)):
        rows = deduplicate_exact(spark, path, digest, files_per_batch=1).collect()
        assert len(rows) == len(ROWS)
        body = [row for row in rows if row["group_size"] == 3]
        assert [row["keep_id"] for row in body] == [5] * 3 and sum(row["kept"] for row in body) == 1
        blank = {row["doc_id"]: row for row in rows if row["doc_id"] in (3, 4, 8)}
        assert blank[4]["keep_id"] == 3 and not blank[4]["kept"] and blank[8]["kept"]
    assert deduplicate_exact(spark, empty).count() == 0


def test_near_duplicates(spark, docs, nothing):
    rows = near_duplicates(docs).collect()
    groups = {(row["doc_id"], row["group_id"], row["kept"]) for row in rows}
    assert {(5, 5, True), (6, 5, False), (None, 5, False), (3, 3, True), (4, 4, True), (7, 7, True)} <= groups
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r[0] for r in kept.select("doc_id").collect()) == [1, 3, 4, 5, 7, 8]
    assert near_duplicates(nothing).count() == 0


def test_near_duplicates_in_crowded_buckets(spark):
    """Documents of one template meet in the same buckets; each is a near copy of one other only."""
    template, rows = " ".join("t%d" % n for n in range(450)), []
    for n in range(200):
        passage = " ".join("p%dx%d" % (n, k) for k in range(25))
        rows += [(2 * n + k, f"{template} {passage} {' '.join('o%dx%dx%d' % (n, k, j) for j in range(3))}") for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near_duplicates(docs, bands=12, rows=1).collect()
    assert {(row["doc_id"], row["group_id"]) for row in found} == {(n, n - n % 2) for n in range(400)}


@pytest.mark.parametrize("common", [40, 2**20])
def test_document_frequencies_are_exact(spark, common):
    """Against plain counts, with more shingles than any small table of hash buckets tells apart."""
    rng, rows = random.Random(3), []
    for n in range(600):
        text = " ".join(rng.choices(WORDS, k=500))
        rows.append((n, text if n % 3 else f"{' '.join(WORDS[: 60 + n % 7])} {text[:900]}"))
    rows += [(1000 + n, rows[n % 50][1] + " and more") for n in range(100)]
    bags = {n: Counter(tuple(text.split()[k : k + 5]) for k in range(len(text.split()) - 4)) for n, text in rows}
    df = Counter(shingle for bag in bags.values() for shingle in bag)
    idf = {shingle: math.log(1 + (1 + len(rows)) / (1 + n)) for shingle, n in df.items()}
    texts = spark.createDataFrame(rows, "row_key long, text string").repartition(3)
    shared, own = minhash.frequencies(texts, 5, common)
    known = shared.value
    assert len(known.shingles) <= common and (own is None) == (common > len(df))
    joined = {} if own is None else {row["row_key"]: row for row in own.collect()}
    for n, text in rows[::29] + rows[-3:]:
        data = text.encode()
        values, _, _ = minhash.shingles(minhash.lane_words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), minhash.PUNCTUATION), 5)
        pair = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        if n in joined:
            keys, counts = np.array(joined[n]["own"], np.int64).view(np.uint64), np.array(joined[n]["own_n"])
            pair = keys[np.argsort(keys)], counts[np.argsort(keys)]
        assert np.allclose(np.sort(known.idf(values, *pair)), sorted(idf[shingle] for shingle in bags[n]))


def test_a_shared_template_joins_in_proportion_to_the_documents(spark):
    """Documents that share four fifths of their words, not enough, meet on nothing in the prefix join."""
    joined = []
    for count in (200, 400):
        template = " ".join("t%d" % n for n in range(300))
        rows = [(n, n, f"{template} {' '.join('o%dx%d' % (n, k) for k in range(70))}", None, None) for n in range(count)]
        texts = spark.createDataFrame(rows, "node long, component long, text string, own array<long>, own_n array<long>")
        known, _ = minhash.frequencies(texts.select(F.col("node").alias("row_key"), "text"), 5)
        schema = "shingle long, node long, component long, rest double, total double"
        prefixes = texts.repartition(2).mapInArrow(minhash._prefixed(5, known, 0.8), schema).cache()
        index = minhash.index_prefixes(prefixes, 0.8)
        assert index.count() > 0
        joined.append(index.select("shingle").join(prefixes.select("shingle"), "shingle").count())
        assert minhash._remaining_pairs(texts, 0.8, 5, known).count() == 0
    assert joined[1] <= 2.2 * joined[0]


def test_prefix_join_finds_every_similar_pair(spark):
    rng, rows = random.Random(8), []
    for n in range(60):
        words = rng.choices(WORDS, k=60) if n % 3 == 0 else rows[-1][2].split()[: 60 - 3 * (n % 3)] + ["x%d" % n]
        rows.append((n, n, " ".join(words), None, None))
    texts = spark.createDataFrame(rows, "node long, component long, text string, own array<long>, own_n array<long>")
    known, _ = minhash.frequencies(texts.select(F.col("node").alias("row_key"), "text"), 5)
    similar = {
        (a[0], b[0])
        for a, b in itertools.combinations(rows, 2)
        if minhash.weighted_jaccard(a[2], b[2], 5, known.value, np.zeros(0, np.uint64), np.zeros(0, np.int64)) >= 0.7
    }
    found = {(r["a"], r["b"]) for r in minhash._remaining_pairs(texts, 0.7, 5, known).collect()}
    assert similar and similar <= found


def test_prefix_join_within_and_across_components(spark):
    """Nodes of one large component do not meet each other but all others, whichever of them has most rows of a shingle."""
    rng, rows = random.Random(9), []
    base = rng.choices(WORDS, k=60)
    for n in range(50):
        words = base[: 60 - n % 5] + ["x%d" % n] * (n % 4)
        rows.append((n, 0 if n < 30 else 30 if n < 40 else n, " ".join(words), None, None))
    texts = spark.createDataFrame(rows, "node long, component long, text string, own array<long>, own_n array<long>")
    known, _ = minhash.frequencies(texts.select(F.col("node").alias("row_key"), "text"), 5)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    similar = {
        (a[0], b[0])
        for a, b in itertools.combinations(rows, 2)
        if a[1] != b[1] and minhash.weighted_jaccard(a[2], b[2], 5, known.value, *none) >= 0.8
    }
    pairs = [(r["a"], r["b"]) for r in minhash._remaining_pairs(texts, 0.8, 5, known).collect()]
    assert similar and similar <= set(pairs) and len(pairs) == len(set(pairs))
    assert all(rows[a][1] != rows[b][1] for a, b in pairs)


def test_near_copies_in_a_large_group(spark):
    """The copies that share a text do not make it weigh little: each has four words of 200 for itself, 0.81 of its
    shingles in common with the first."""
    rng, rows = random.Random(11), []
    base = ["b%d" % n for n in range(200)]
    for n in range(30):
        words = list(base)
        for place in (20, 70, 120, 170) if n else ():
            words[place + n % 9] = "c%dx%d" % (n, place)
        rows.append((n, " ".join(words)))
    rows += [(n, " ".join(rng.choices(WORDS, k=20))) for n in range(30, 1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for options in ({"common": 20}, {}):
        found = {row["doc_id"]: row["group_id"] for row in near_duplicates(docs, **options).collect()}
        assert found == {n: 0 if n < 30 else n for n in range(1500)}


def test_text_order_survives_equal_leading_bits():
    values = np.array([5, 3, 5, 4, 2**63 + 1, 5, 3], np.uint64)
    texts = np.array([0, 0, 0, 0, 1, 1, 1])
    order = minhash._text_order(values, texts)
    assert values[order].tolist() == [3, 4, 5, 5, 3, 5, 2**63 + 1] and texts[order].tolist() == [0] * 4 + [1] * 3


@pytest.mark.parametrize("separates", [common._IS_SPACE, common.PUNCTUATION])
def test_lane_hashes_tell_words_apart(separates):
    rng = random.Random(2)
    pieces = ["".join(rng.choices("abcdé", k=rng.randrange(1, 30))) for _ in range(400)] + ["", " ", ", ", "x" * 100]
    texts = [rng.choice([" ", ", ", "\n"]).join(rng.choices(pieces, k=rng.randrange(12))).encode() for _ in range(300)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(text) for text in texts])])
    fast, plain = common.lane_words(data, offsets, separates), common.words_of(data, offsets, separates)
    for name in ("starts", "ends", "first"):
        assert getattr(fast, name).tolist() == getattr(plain, name).tolist()
    spelled = [data[a:b].tobytes() for a, b in zip(fast.starts, fast.ends)]
    by_hash = dict(zip(fast.hashes.tolist(), spelled))
    assert len(by_hash) == len(set(spelled)) and [by_hash[h] for h in fast.hashes.tolist()] == spelled


def test_near_duplicates_equal_brute_force(spark):
    rng, rows = random.Random(4), []
    for n in range(40):
        words = rng.choices(WORDS, k=120) + WORDS[:60] * (n % 2)
        for k in range(3):
            rows.append((3 * n + k, " ".join(words[: len(words) - 4 * k * (n % 8)])))
    bags = [Counter(tuple(text.split()[k : k + 5]) for k in range(len(text.split()) - 4)) for _, text in rows]
    df = Counter(shingle for bag in bags for shingle in bag)
    weigh = lambda bag: sum(n * math.log(1 + (1 + len(rows)) / (1 + df[shingle])) for shingle, n in bag.items())
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if weigh(bags[a] & bags[b]) >= 0.8 * weigh(bags[a] | bags[b]):
            low, high = sorted((group[a], group[b]))
            group = [low if g == high else g for g in group]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for options in ({"bands": 30, "rows": 2, "common": 20}, {}):  # and the query's own parameters
        found = near_duplicates(docs, **options).collect()
        assert {row["doc_id"]: row["group_id"] for row in found} == dict(enumerate(group))


def test_sampling_follows_weighted_jaccard():
    rng = np.random.default_rng(1)
    shared = rng.integers(1, 2**63, 200, dtype=np.uint64)
    a = np.sort(np.concatenate([shared, rng.integers(1, 2**63, 40, dtype=np.uint64)]))
    b = np.sort(np.concatenate([shared, rng.integers(1, 2**63, 40, dtype=np.uint64)]))
    values, texts = np.concatenate([a, b]), np.repeat([0, 1], [240, 240])
    _, drawn = minhash.signatures(values, texts, np.ones(480), 250)
    assert abs((drawn[0] == drawn[1]).mean() - 200 / 280) < 0.1


def test_components(spark):
    edges = [(n, n + 1) for n in range(1, 40)] + [(100, 7), (200, 201), (202, 201), (5, 5)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    found = {row["node"]: row["component"] for row in rows}
    assert len(rows) == len(found) and {found[n] for n in [*range(1, 41), 100]} == {1} and found[202] == 200


def test_packing(docs, nothing):
    rows = pack_documents(docs, tokenizer_path(), 4096).collect()
    tokenizer = WordTokenizer(tokenizer_path())
    for row in rows:
        if row["doc_id"] == 7:
            ids = tokenizer.ids(LONG) + b"\1\0\0\0"
            own = ids[4 * row["start"] : 4 * (row["start"] + row["length"])]
            assert row["ids_crc32"] == zlib.crc32(own)
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), lambda r: r["sequence_id"]):
        place = 0
        for row in group:
            assert row["offset"] == place
            place += row["length"]
        assert place <= 4096
    assert sum(row["doc_id"] == 5 for row in rows) == 2 and sum(row["doc_id"] == 3 for row in rows) == 1
    assert pack_documents(nothing, tokenizer_path()).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(257, np.int64)
    counts[1:] = rng.integers(0, [2, 50, 1000, 3][seed], 256)
    plan = plan_packing(counts)
    used = np.zeros_like(counts)
    for parts, times in plan:
        assert sum(parts) <= 256 and times > 0
        for part in parts:
            used[part] += times
    assert (used == counts).all()
    assert sum(times for _, times in plan) <= 1.02 * (counts * np.arange(257)).sum() / 256 + 2


def test_permutation_and_shards(spark, docs, nothing):
    for count in (1, 2, 5, 1000):
        assert sorted(permute(np.arange(count), count, 9).tolist()) == list(range(count))
    assert permute(np.arange(1000), 1000, 9).tolist() != permute(np.arange(1000), 1000, 10).tolist()
    shards = write_in_training_order(docs, tokenizer_path(), 3, sequence_tokens=64, shard_sequences=100)
    rows = manifest(spark, shards).collect()
    assert sorted(row["slot"] for row in rows) == list(range(shards.sequences))
    assert all(row["intact"] and row["stride"] == 128 and row["shard"] == row["slot"] // 100 for row in rows)
    assert [row["slot"] for row in shards.read(spark, 95, 10).orderBy("slot").collect()] == list(range(95, 105))
    assert manifest(spark, write_in_training_order(nothing, tokenizer_path(), 3)).count() == 0


def test_tokens_equal_the_tokenizer():
    from tokenizers import Tokenizer

    whole, ours = Tokenizer.from_file(tokenizer_path()), WordTokenizer(tokenizer_path())
    characters = [chr(c) for c in range(1, 0x250)] + list(" '''  sstdm.,re") * 10
    texts = ["a'st !'s ''s", "İstanbul ΑΣ", "x <|endoftext|> y", "a\x1cb\x85c\xa0d 1²3½", "", " \n"]
    texts += ["".join(_random.choices(characters, k=40)) for _ in range(300)]
    for text in texts:
        assert np.frombuffer(ours.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("cut_bytes, joined_units, cached_units", [(4_000_000, 1_000, 600_000), (60, 3, 20)])
def test_columns_of_texts_equal_the_tokenizer(monkeypatch, cut_bytes, joined_units, cached_units):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "CUT_BYTES", cut_bytes)
    monkeypatch.setattr(tokens, "JOINED_UNITS", joined_units)
    monkeypatch.setattr(tokens, "CACHED_UNITS", cached_units)
    whole, ours = Tokenizer.from_file(tokenizer_path()), WordTokenizer(tokenizer_path())
    # Kinds of one and two bytes, marks that join the letter before them in one case only, markers in both cases.
    parts = ["DON'T\u0308", "it's", "''s", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "naïve", "Œuvre", "²3½", "×", "\u0301", "ΣΑΣ", "“x”", "中文", "각"]
    parts += ["</w>", "İ", "12", "The", "the", "!?", " ", "  ", "\n", "\x85", "\xa0", "\x1c", "\u2028", "😀", "a", "É"]
    texts = [None, "", " ", *("".join(_random.choices(parts, k=_random.choice([1, 4, 30]))) for _ in range(400)), None]
    found = []
    for ids, ends in ours.columns(pa.array(["cut off", *texts]).slice(1)):
        found += [own.tolist() for own in np.split(ids, ends)[:-1]]
        assert len(ids) == ends[-1]
    assert found == [[*whole.encode(text or "", add_special_tokens=False).ids, 1] for text in texts]


def _counted():
    """A tokenizer, and the texts that reach the one below it."""
    ours, passed = WordTokenizer(tokenizer_path()), []
    encode = ours._tokenizer.encode_batch_fast

    class Counted:
        def encode_batch_fast(self, texts, **settings):
            passed.extend(texts)
            return encode(texts, **settings)

    ours._tokenizer = Counted()
    return ours, passed


REPEATED = [f"“Plain” words — don't stop, naïve {number % 5} and again plain words" for number in range(50)]


def test_equal_words_are_encoded_once_whatever_the_text():
    ours, passed = _counted()
    for text in REPEATED:
        ours.ids(text)
    assert sum(map(len, passed)) < 200


def test_sequences_encode_equal_words_once(monkeypatch):
    from tokenizers import Tokenizer

    ours, passed = _counted()
    monkeypatch.setattr(tokens, "word_tokenizer", lambda path: ours)
    monkeypatch.setattr(tokens, "CUT_BYTES", 500)
    made = list(tokens.token_sequences(tokenizer_path(), 8)(pa.array([*REPEATED, None])))
    assert sum(map(len, passed)) < 200
    whole = Tokenizer.from_file(tokenizer_path())
    texts = [[*whole.encode(text, add_special_tokens=False).ids, 1] for text in [*REPEATED, ""]]
    assert [count for counts, _ in made for count in counts.tolist()] == [-(-len(ids) // 8) for ids in texts]
    cut = [(at // 8, at, ids[at : at + 8]) for ids in texts for at in range(0, len(ids), 8)]
    wanted = [
        (piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()), np.array(own, "<u2").tobytes())
        for piece, start, own in cut
    ]
    assert [tuple(row.values()) for _, batch in made for row in batch.to_pylist()] == wanted


def test_places_count_pieces_of_a_length(monkeypatch):
    from pyspark import TaskContext

    monkeypatch.setattr(tokens, "CUT_BYTES", 40)
    monkeypatch.setattr(TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 3})())
    texts = ["one two three", None, "one two three", "", "one " * 11, "a b", "one two three"]
    batch = pa.RecordBatch.from_arrays([pa.array([5, 5, None, 1, 2, 3, 4], pa.int64()), pa.array(texts)], ["doc_id", "text"])
    made = pa.Table.from_batches(tokens.token_pieces(tokenizer_path(), 5)(iter([batch, batch])))
    rows = made.to_pylist()
    assert [row["doc_id"] for row in rows] == 2 * [5, 5, None, 1, 2, 2, 2, 3, 4] and {row["part"] for row in rows} == {3}
    assert [(row["piece"], row["start"], row["length"]) for row in rows if row["doc_id"] == 2][:3] == [(0, 0, 5), (1, 5, 5), (2, 10, 2)]
    seen = Counter()
    for row in rows:
        assert row["place"] == seen[row["length"]]
        seen[row["length"]] += 1


def test_urls(spark):
    urls = [None, "no scheme", "http://A.Example.com/en/x?q", "https://www.example.com/en/", "http://example.com/english",
            "http://shop.net/fr/1", "http://cheap-pills.org/", "http://com", "ftp://x.org?a=://b.com/", "http://net/es/"]
    pages = spark.createDataFrame([(n, url, 1) for n, url in enumerate(urls)], "page_id long, url string, token int")
    rows = {row["page_id"]: row for row in judge_urls(pages).collect()}
    assert [(rows[n]["rule"], rows[n]["verdict"]) for n in range(10)] == [
        (None, "allow"), (None, "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("com/", "allow"),
        ("net/fr/", "block"), (None, "block"), (None, "allow"), (None, "allow"), ("net/es/", "block")]
    assert rows[2]["host"] == "a.example.com" and rows[8]["host"] == "x.org" and rows[0]["path"] == ""
    odd = judge_urls(pages, [site_rule("block", "org", "/"), site_rule("block", "x.org", "")]).where("page_id = 8").first()
    assert odd["rule"] == "x.org"
    assert judge_urls(pages.limit(0)).count() == 0


def test_wand_equals_brute_force():
    rng = np.random.default_rng(2)
    items = [(n, " ".join(rng.choice(WORDS, rng.integers(1, 40)))) for n in range(60)]
    index = Index.build(items, Settings(posting_block=4))
    for turn in range(200):
        query = rng.choice(len(index.vocabulary), rng.integers(1, 90), replace=False).tolist()
        threshold = (0.05, 0.2, 0.6)[turn % 3]
        scores = np.zeros(len(items))
        for term in query:
            scores[index.postings[term].items] += index.postings[term].impacts
        assert {i for i, _ in index.above(query, threshold)} == set(np.flatnonzero(scores >= threshold - 1e-9).tolist())


def test_leaks(spark, docs, nothing):
    item = " ".join("Q%d" % n for n in range(40))
    texts = [(1, LONG + " " + item + " " + PASSAGE), (2, " ".join("Q%d" % n for n in range(15))), (3, None), (4, BODY)]
    corpus = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame([(9, item), (9, item), (10, None), (11, "")], "item_id long, text string")
    found = find_leaks(corpus, bench).collect()
    assert [(row["doc_id"], row["item_id"]) for row in found] == [(1, 9)]
    assert sorted(row["doc_id"] for row in drop_leaking(corpus, bench).collect()) == [2, 3, 4]
    assert [(r["doc_id"]) for r in find_leaks(corpus, bench, index_bytes=1).collect()] == [1]
    assert find_leaks(corpus, bench.limit(0)).count() == 0 and find_leaks(nothing, bench).count() == 0
    assert drop_leaking(docs, bench).columns == docs.columns


def test_leaks_of_partial_copies(spark):
    """The last 30 of 50 words: half of the question's shingles and the whole answer, 0.6 of the score."""
    words = ["q%d" % n for n in range(50)]
    corpus = spark.createDataFrame([(1, BODY + " " + " ".join(words[20:])), (2, " ".join(words[30:]))], "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(words))], "item_id long, text string")
    rows = find_leaks(corpus, bench).collect()
    assert [(row["doc_id"], row["question_overlap"], row["answer_overlap"]) for row in rows] == [(1, 0.5, 1.0)]


def test_clause_grammar():
    lexicon = Lexicon({"idiot": 1.0}, {"vequ": 0.8})
    plain, aimed = clause_weight("what an idiot", lexicon), clause_weight("you idiot", lexicon)
    assert aimed > plain > clause_weight("not an idiot", lexicon) > clause_weight("he said not idiot", lexicon) * 0.9
    assert clause_weight("i will kill you", lexicon) < clause_weight("you they kill", lexicon)
    assert clause_weight("la vequance", lexicon) == 0.8 and clause_weight("vequ", lexicon) == 0.0
    weights = toxicity.matched_clauses("good. you idiot! fine, vequer; end", lexicon, lexicon.cues())
    assert len(weights) == 2


def test_lexicon_learns_rare_insults_among_many_words(spark):
    """More words reach the support than any list of the most frequent ones holds."""
    names = ["".join(p) for p in itertools.product("bcdfghklmnprstvw", "aeiou", "bcdfghklmnprst", "aeio", "bdfgklmnprstvw")]
    common = " ".join(names[:55_000])
    rows = [(n, f"{common} x{'abcdefghijkl'[n]}x" + (" vermaxx" if n < 8 else ""), 1) for n in range(12)]
    rows += [(100 + n, f"{common} y{'abcdefghij'[n % 10]}y{n}", 0) for n in range(30)]
    sample = spark.createDataFrame(rows, "row long, text string, toxic int").repartition(8)
    assert "vermax" in toxicity.learn_lexicon(sample).stems


def test_toxicity_scores(docs, nothing):
    model = ToxicityModel(Lexicon({"idiot": 1.0}, {}), (-3.0, 4.0, 1.0))
    rows = score_toxicity(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= row["score"] <= 1 and row["predicted"] == 0 for row in rows)
    held = {row["doc_id"]: row["held_out"] for row in rows}
    assert held == {n: n is not None and zlib.crc32(str(n).encode()) % 5 == 0 for n in held}
    assert score_toxicity(nothing, model).count() == 0


def _clean_and_junk(rng, count, clean=0.75):
    """Pages of two kinds that differ in words and, mostly, in source and size."""
    rows, marks = [], {}
    for n in range(count):
        good = rng.random() < clean
        words = rng.choices(WORDS[:200] if good else ["BUY", "$$$", "now!!!", "x9", "CLICK"], k=rng.randrange(5, 80))
        text = " ".join(words) + ("." if good else "")
        source = rng.choice(["wiki", "news"]) if good == (rng.random() < 0.95) else "spam"
        rows.append((n, text, "en", source, len(text), "x", n))
        marks[n] = int(good)
    return rows, marks


def test_quality(docs, nothing):
    rng = np.random.default_rng(0)
    marks = (np.arange(200) % 4 > 0).astype(float)
    width = {"content": quality._SHAPES + quality._LAYOUT, "metadata": quality._LANGS + quality._SOURCES + quality._SIZES + 1}
    views = {n: rng.normal(size=(200, w)).astype(np.float32) + marks[:, None] * 2 for n, w in width.items()}
    model = co_train(views, marks, ArrayPool(np.arange(100), {n: v[:100] for n, v in views.items()}))
    assert model.pseudo_labels > 0
    assert ((model.scores(views)[2] >= 0.5) == (marks > 0)).mean() > 0.95
    assert score_quality(docs, model).count() == len(ROWS) and score_quality(nothing, model).count() == 0
    kept = keep_quality(docs, model)
    assert kept.columns == docs.columns and kept.count() == score_quality(docs, model).where("keep").count()
    assert score_quality(docs, None).where("keep").count() == len(ROWS)


def test_quality_pool_in_a_table_equals_one_in_memory(spark):
    rng = random.Random(5)
    rows, marks = _clean_and_junk(rng, 400)
    rows += [(1000 + n, *rows[n % 40][1:]) for n in range(60)]  # copies take one place
    features = quality_features(spark.createDataFrame(rows, SCHEMA)).cache()
    table = features.orderBy("row_key").toArrow().combine_chunks()
    columns = [quality._whole(table.column(name)) for name in quality.FEATURE_NAMES]
    views, prints = quality.view_rows(columns), table.column("print").to_numpy()
    labels = np.array([marks[n % 1000 % 400 if n < 1000 else (n - 1000) % 40] for n in table.column("doc_id").to_pylist()], float)
    fitted = {name: quality.View.fit(views[name][:200], labels[:200]) for name in quality.VIEWS}
    given = {"content": set(prints[:3].tolist()), "metadata": set()}
    for most in ({1: 7, 0: 3}, {1: 10_000, 0: 10_000}):
        in_memory = ArrayPool(prints, views).surest(fitted, most, given)
        for partitions in (1, 5):
            in_table = TablePool(features.repartition(partitions)).surest(fitted, most, given)
            for one, two in zip(in_memory, in_table, strict=True):
                assert (one.by, one.mark, set(one.prints)) == (two.by, two.mark, set(two.prints))
                assert len(set(two.prints)) == len(two.prints) <= most[two.mark]
                order = [two.prints.index(p) for p in one.prints]
                for view in quality.VIEWS:
                    assert np.array_equal(one.views[view], two.views[view][order])


def test_quality_is_learned_from_all_unlabelled_pages(spark):
    rng = random.Random(6)
    rows, marks = _clean_and_junk(rng, 600)
    docs = spark.createDataFrame(rows, SCHEMA)
    labelled = [(n, marks[n]) for n in range(150)]
    # Repeated, conflicting, foreign and null labels.
    odd = labelled + labelled[:20] + [(149, 0), (149, 1), (9999, 1), (None, 1), (200, None), (201, 7)]
    features = quality_features(docs).cache()
    model = fit_quality(features, spark.createDataFrame([(*row, "x", "y") for row in odd], "doc_id long, quality int, row_key string, kind string"))
    assert model.pseudo_labels > 20
    scored = score_features(features, model)
    right = [row["keep"] == bool(marks[row["doc_id"]]) for row in scored.collect() if row["doc_id"] >= 150]
    assert sum(right) / len(right) > 0.95
    assert sorted(map(repr, scored.collect())) == sorted(map(repr, score_quality(docs, model).collect()))
    assert fit_quality(features, spark.createDataFrame([(1, 1)], "doc_id long, quality int")) is None
    assert fit_quality(features, spark.createDataFrame([], "doc_id long, quality int")) is None
    assert fit_quality(quality_features(docs.limit(0)), spark.createDataFrame(labelled, "doc_id long, quality int")) is None


def test_quality_features_do_not_depend_on_the_slice(spark, monkeypatch):
    rows = [(n, text, "en", "a", 1, "x", 1) for n, text in enumerate(["Ä" * 5000, "É É e é", "A" * 5000 + " " + "b" * 9000, "\n\n", "x.\ny", "1 1 2"] * 3)]
    features = quality_features(spark.createDataFrame(rows, SCHEMA).coalesce(1)).drop("doc_id", "row_key").distinct()
    assert features.count() == 6


def test_rerun_of_exact_state(spark, tmp_path):
    """Files added between runs: each run gives the result for all files, and one without new files as well."""
    path, state = str(tmp_path / "documents.parquet"), f"file://{tmp_path}/state"
    spark.createDataFrame([(5, "one"), (6, "two")], "doc_id long, text string").write.parquet(path)
    deduplicate_exact(spark, path, checkpoint=state).collect()
    spark.createDataFrame([(3, "one"), (9, "three")], "doc_id long, text string").write.mode("append").parquet(path)
    for _ in range(2):
        rows = {row["doc_id"]: (row["keep_id"], row["group_size"], row["kept"]) for row in deduplicate_exact(spark, path, checkpoint=state).collect()}
        assert rows == {5: (3, 2, False), 3: (3, 2, True), 6: (6, 1, True), 9: (9, 1, True)}


def test_lines_of_a_long_document_take_linear_time(spark):
    times = []
    for count in (4_000, 16_000):
        text = "\n".join("line %d of a document that repeats itself, at length and in full" % (n % (count // 2)) for n in range(count))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        deduplicate_lines(docs).collect()
        begin = time.perf_counter()
        (row,) = deduplicate_lines(docs).collect()
        times.append(time.perf_counter() - begin)
        assert row["lines_removed"] == count // 2 and len(row["text"].split("\n")) == count // 2
    assert times[1] < 4 * times[0] + 1


def test_texts_go_to_python_in_bounded_batches(spark):
    """Executors and workers hold some thousand texts at a time, whatever the session's default of rows is."""
    import pyarrow as pa

    from adpulse.session import session_conf

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["rows"])

    def seen():
        rows = common.staged(spark.range(0, 9000, 1, 1).mapInArrow(sizes, "rows long"), "sizes").collect()
        return sum(row["rows"] for row in rows), max(row["rows"] for row in rows)

    assert seen() == (9000, common.BATCH_ROWS)
    with session_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "700"}):
        assert seen() == (9000, 700)


def test_decontamination_holds_a_bounded_slice_of_text():
    import tracemalloc

    import pyarrow as pa

    from adpulse.llm import decontaminate

    index = Index.build([(1, " ".join(WORDS[:60]))], Settings())
    batch = pa.RecordBatch.from_arrays([pa.array([BODY] * 30_000)], ["text"])
    tracemalloc.start()
    counted = list(decontaminate._counted(index)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(counted[0].column("n").to_pylist()) == 30_000 * sum(word in WORDS[:60] for word in BODY.split())
    assert peak < 30_000_000


def test_open_shingles_decide_as_exact_weights_do():
    """Draws from bounds of the weights, completed by the open shingles, are those of the exact weights."""
    rng = np.random.default_rng(7)
    texts = np.repeat(np.arange(80), rng.integers(1, 400, 80))
    values = np.sort(rng.integers(0, 2**64, len(texts), dtype=np.uint64))[np.argsort(rng.random(len(texts)))]
    values = values[np.lexsort((values, texts))]
    known = minhash.Frequencies(100_000, np.zeros(0, np.uint64), np.zeros(0, np.int64), 50)
    times, n = rng.integers(1, 4, len(texts)), rng.integers(1, 51, len(texts))
    weight = times * known.rarity(n)
    early, open_ = minhash.draws(values, texts, times * known.rarity(np.array(1)), 30, times * known.rarity(np.array(50)))
    late, _ = minhash.draws(values[open_], texts[open_], weight[open_], 30)
    some = np.isin(early.texts, late.texts)
    early = minhash.Draws(*(x[some] for x in (early.texts, early.low, early.shingles, early.levels)))
    _, exact = minhash.signatures(values, texts, weight, 30)
    assert (early.best(late).hashes() == exact[some]).all()
    assert 0 < open_.mean() < 0.2


def test_signing_moves_no_texts(spark, tmp_path):
    """Signatures equal those of the exact frequencies, and only open shingles and the rows that wait for them move."""
    rng, rows = random.Random(6), []
    for n in range(300):
        words = rng.choices(WORDS, k=300) if n % 2 else rows[-1][2].split()[:250] + ["y%d" % k for k in range(n % 50)] if n else ["one"]
        rows.append((n, n, " ".join(words)))
    rows += [rows[7], (400, 400, None), (401, 401, "")]
    texts = spark.createDataFrame(rows, "row_key long, rank_id long, text string").repartition(3)
    known, counts, least = minhash._shared_counts(texts, 5, 30)
    assert least > 2
    others = counts.where(F.col("n") < least)
    found = minhash._signatures(texts, 5, known, others, 10, 3)
    everything, none, one = minhash._shared_counts(texts, 5, 2**20)
    whole = minhash._signatures(texts, 5, everything, None, 10, 3)
    assert one == 2 and sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))
    asked = [row for batch in texts.select("row_key", "rank_id", "text").coalesce(1).toArrow().to_batches() for row in minhash._signed(5, known, 10, 3)([batch])]
    waiting = [x for batch in asked for x in batch.column("open").to_pylist() if x]
    assert waiting and sum(map(len, waiting)) < sum(len(text.split()) for _, _, text in rows if text) / 4
