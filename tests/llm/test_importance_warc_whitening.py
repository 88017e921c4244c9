"""Importance resampling, WARC archives and whitening: brute force, round trips and odd input."""

from __future__ import annotations

import gzip
import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, IsNull, Not, StringStartsWith

from adpulse.llm import oracles, queries, warc, whitening
from adpulse.llm.importance import Ngrams, NgramTable, bucket_gains, resample, xxhash64
from adpulse.llm.warc import archive_pages, encode_record, gzip_member, holds, raw_records, read_archived_pages, read_warc
from adpulse.llm.whitening import bidiagonalise, dqds, right_vectors, whiten

DOCS = "doc_id long, text string, score string, weight int, n_words string, lang string"
_random = random.Random(11)
WORDS = [f"w{n}" for n in range(60)] + ["Ärger", "naïve", "x" * 40, "日本語", "A1b2"]


def _text(size):
    return "".join(_random.choice(WORDS) + _random.choice([" ", ", ", "\n", "--"]) for _ in range(size))


TEXTS = [_text(_random.randrange(0, 60)) for _ in range(60)]
DOC_ROWS = (
    [(n, text, "s", 1, "x", "en") for n, text in enumerate(TEXTS)]
    + [(100, None, None, None, None, None), (101, "", "", 0, "", ""), (102, " \n\t-", "s", 1, "x", "en")]
    + [(103, TEXTS[1], "s", 1, "x", "en")] * 2
    + [(None, _text(40), "s", 1, "x", "en"), (None, _text(40), "s", 1, "x", "de"), (104, "lang " * 20_000, "s", 1, "x", "en")]
)
ITEMS = [(1, _text(30), 5), (2, None, 5), (3, "", 5), (4, _text(10), 5)]


def _words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def _features(text, most):
    words = _words(text)
    return [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("size", [1, 2, 7, 8, 9, 31, 32, 33, 100])
def test_hashes_equal_the_library(size):
    data = np.frombuffer(np.random.default_rng(size).bytes(5000) + b" " * 8, np.uint8)
    starts = np.arange(0, 4800, 37)
    ends = starts + size
    expected = [xxhash.xxh64_intdigest(data[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert xxhash64(data, starts, ends).tolist() == expected


@pytest.mark.parametrize("hashes", [None, 0, 3])
@pytest.mark.parametrize("most", [1, 3])
def test_table_tells_equal_keys_apart_by_bytes(hashes, most):
    texts = [text.encode() for text in TEXTS]
    data = np.frombuffer(b"".join(texts), np.uint8)
    grams = Ngrams.of(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]), most)
    expected = [f for text in TEXTS for f in _features(text, most)]
    # Every n-gram with the same key, or with one of three.
    own = None if hashes is None else np.arange(len(grams), dtype=np.uint64) * 0
    if hashes:
        own = np.array([len(grams.data[a:b]) % hashes for a, b in zip(grams.starts, grams.ends)], np.uint64)
    table = NgramTable(grams, 10_000, own)
    found = Counter()
    for slot in table.used:
        held = table._holder[slot]
        found[grams.data[grams.starts[held] : grams.ends[held]].tobytes().decode()] = int(table.count[slot])
    assert found == Counter(expected)
    counts = Counter(zlib.crc32(f.encode()) % 10_000 for f in expected)
    assert {b: n for b, n in enumerate(table.bucket_counts(10_000).tolist()) if n} == counts
    gains = np.arange(10_000) * 3
    assert table.gather(gains).sum() == sum(3 * b * n for b, n in counts.items())


@pytest.mark.parametrize("most", [1, 2])
def test_resampling_equals_brute_force(spark, most):
    docs = spark.createDataFrame(DOC_ROWS, DOCS)
    target = spark.createDataFrame(ITEMS, "item_id long, text string, weight int")
    rows = resample(docs, target, share_percent=30, max_words=most, buckets=500).collect()
    assert len(rows) == len(DOC_ROWS) and rows[0].asDict().keys() == {"doc_id", "n_features", "weight", "score", "rank"}
    corpus = Counter(zlib.crc32(f.encode()) % 500 for row in DOC_ROWS for f in _features(row[1], most))
    wanted = Counter(zlib.crc32(f.encode()) % 500 for row in ITEMS for f in _features(row[1], most))
    s_all, t_all = sum(corpus.values()), sum(wanted.values())
    gain = [
        math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 500) / ((corpus[b] + 1) * (t_all + 500)))) for b in range(500)
    ]
    expected = []
    for doc_id, text, *_ in DOC_ROWS:
        features = _features(text, most)
        weight = sum(gain[zlib.crc32(f.encode()) % 500] for f in features) // max(1, len(features))
        h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        expected.append((doc_id, len(_words(text)), len(features), weight, weight + noise))
    with_id = {(r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in rows if r["doc_id"] is not None}
    assert with_id == {(d, n, w, s) for d, _, n, w, s in expected if d is not None}
    # Rows without an id have noise of their own text; take it from the result, and the draw from all scores.
    draw = sorted(
        [(-s, d) for d, n, _, _, s in expected if d is not None and n >= 20]
        + [(-r["score"], math.inf) for r in rows if r["doc_id"] is None]
    )
    drawn = 30 * len(draw) // 100
    ranked = sorted((r["rank"], r["score"], r["doc_id"]) for r in rows if r["rank"] is not None)
    assert [(-s, math.inf if d is None else d) for _, s, d in ranked] == draw[:drawn]
    assert [rank for rank, _, _ in ranked] == list(range(1, drawn + 1))


def test_resampling_of_nothing(spark):
    docs, nothing = spark.createDataFrame(DOC_ROWS, DOCS), spark.createDataFrame([], DOCS)
    items = spark.createDataFrame(ITEMS, "item_id long, text string, weight int")
    assert resample(nothing, items).count() == 0
    assert resample(docs, nothing).where("rank is not null").count() > 0
    assert resample(docs, items, share_percent=0).where("rank is not null").count() == 0
    assert bucket_gains(nothing, nothing, 7).tolist() == [0] * 7


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_warc"])
def test_query_equals_sql(spark, sf_dir, name):
    import compare

    ours = compare.spark_result(queries.queries()[name](spark, sf_dir))
    assert compare.difference(ours, compare.duckdb_result(compare.connect(sf_dir), oracles.ORACLES[name])) is None


# -- archives ----------------------------------------------------------------------------------------------------------

BIG, LONG_HTML = "<p>" + "ä" * 60 + "</p>", "<b>" + "x" * 3_000_000 + "</b>"
PAGES = [
    (5, "http://a/5", BIG, "r1", "p"),
    (3, "http://a/3", BIG, "r2", "p"),
    (9, None, BIG, None, None),
    (9, "http://a/9\r\nWARC-Type: revisit", BIG, "r", "p"),
    (None, "http://a/null", BIG, "r", "p"),
    (1, "http://a/1", "small", "r", "p"),
    (2, "http://a/2", "small", "r", "p"),
    (4, "http://a/4", None, "r", "p"),
    (6, "http://a/6", "", "r", "p"),
    (7, "http://a/7", LONG_HTML, "r", "p"),
    (8, "http://a/8", "\r\n\r\nWARC/1.1\r\n\r\n" + "z" * 100, "r", "p"),
    (None, "u", "lonely" * 30, "r", "p"),
    (None, "v", "lonely" * 30, "r", "p"),
    (11, "t", "tied" * 30, "r", "p"),
    (11, "t", "tied" * 30, "r", "p"),
]
PAGE_SCHEMA = "page_id long, url string, html string, record_type string, payload string"


@pytest.mark.parametrize("options", [{}, {"compressed": "false"}, {"fileBytes": 2000}])
def test_pages_round_trip(spark, options):
    path = archive_pages(spark.createDataFrame(PAGES, PAGE_SCHEMA), **options)
    rows = read_archived_pages(spark, path).collect()
    found = sorted(tuple(r)[:5] for r in rows if r["page_id"] is not None)
    expected = []
    for page_id, _, html, *_ in PAGES:
        data = (html or "").encode()
        same = [p for p, _, other, *_ in PAGES if (other or "") == (html or "") and p is not None]
        refers = min(same) if len(data) >= 100 and page_id is not None and page_id > min(same) else None
        expected.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if refers else "response", refers))
    assert found == sorted(row for row in expected if row[0] is not None)
    without_id = Counter((r["payload_bytes"], r["record_type"], r["refers_to"]) for r in rows if r["page_id"] is None)
    assert without_id == {(len(BIG.encode()), "revisit", 3): 1, (180, "response", None): 2}
    assert all(r["intact"] for r in rows)


def test_payloads_come_back_whole(spark):
    path = archive_pages(spark.createDataFrame(PAGES, PAGE_SCHEMA))
    read = read_warc(spark, path).where("record_type = 'response'").select("target_uri", "payload").collect()
    got = {row["target_uri"]: bytes(row["payload"]).decode() for row in read}
    assert got["http://a/7"] == LONG_HTML and got["http://a/8"] == PAGES[10][2] and got["http://a/4"] == ""
    assert read_warc(spark, path).where("target_uri is null").count() == 1
    revisit = read_warc(spark, path).where("target_uri like 'http://a/9%'").first()
    # Control characters of a value cannot make a header line of their own.
    assert revisit["target_uri"] == "http://a/9%0D%0AWARC-Type: revisit" and revisit["record_type"] == "revisit"


def test_empty_tables_and_missing_archives(spark, tmp_path):
    path = archive_pages(spark.createDataFrame([], PAGE_SCHEMA))
    assert read_archived_pages(spark, path).count() == 0
    with pytest.raises(Exception, match="no archive"):
        read_warc(spark, str(tmp_path / "none")).count()


def test_uncommitted_files_are_not_read(spark, tmp_path):
    rows = spark.createDataFrame([("a", "resource")], "record_id string, record_type string")
    path = f"file://{tmp_path}/archive"
    warc.write_warc(rows, path)
    (tmp_path / "archive" / "part-lost.warc.gz").write_bytes(gzip_member(encode_record({"record_id": "lost"})))
    assert [r["record_id"] for r in read_warc(spark, path).collect()] == ["a"]
    warc.write_warc(rows, path)
    assert read_warc(spark, path).count() == 2
    warc.write_warc(rows, path, mode="overwrite")
    assert read_warc(spark, path).count() == 1


RECORDS = [
    {"record_id": "r1", "record_type": "response", "target_uri": "http://x/1", "payload": b"one" * 5000},
    {"record_id": "r2", "record_type": "revisit", "target_uri": "http://x/2", "refers_to": "r1"},
    {"record_id": "r3", "record_type": "warcinfo", "payload": b"software: none\r\n\r\n"},
    {"record_id": "r4", "record_type": "response", "target_uri": "https://y/4", "payload": b"four" * 5000},
]


def _archive(kind):
    parts = [encode_record(record) for record in RECORDS]
    squeeze = {"plain": bytes, "named": gzip_member, "foreign": gzip.compress}[kind]
    return b"".join(map(squeeze, parts))


@pytest.mark.parametrize("kind", ["plain", "named", "foreign"])
def test_archives_of_others(spark, tmp_path, kind):
    (tmp_path / ("a.warc" if kind == "plain" else "a.warc.gz")).write_bytes(_archive(kind))
    rows = read_warc(spark, str(tmp_path)).orderBy("record_id").collect()
    assert [r["record_id"] for r in rows] == ["r1", "r2", "r3", "r4"]
    assert [bytes(r["payload"]) for r in rows] == [record.get("payload", b"") for record in RECORDS]
    read = read_warc(spark, str(tmp_path))
    assert read.where("record_type in ('response', 'x') and target_uri like 'https%'").count() == 1
    assert read.where("record_type <> 'response'").count() == 2
    assert read.where("refers_to is null").count() == 3
    assert read.where("content_length > 10000").count() == 2
    assert read.where("length(payload) > 16000").select("record_id").first()[0] == "r4"


def test_filters_reach_the_reader(spark, tmp_path):
    from conftest import plan_text

    (tmp_path / "a.warc.gz").write_bytes(_archive("named"))
    wanted = read_warc(spark, str(tmp_path)).where("record_type = 'response'").where("length(payload) > 1")
    plan = plan_text(wanted)
    filters = [line for line in plan.splitlines() if " Filter (" in line]
    assert len(filters) == 1 and "record_type" not in filters[0] and "payload" in filters[0]


def test_refused_records_are_not_decoded(monkeypatch):
    data = _archive("named")
    decoded = []
    grow = warc._Member.grow
    monkeypatch.setattr(warc._Member, "grow", lambda self: decoded.append(self._start) or grow(self))
    source = pa.PythonFile(io.BytesIO(data), mode="r")
    records = list(raw_records(source, "memory"))
    # One step each is enough for the headers; no payload was decoded.
    assert [r.headers["WARC-Record-ID"] for r in records] == ["r1", "r2", "r3", "r4"]
    assert len(decoded) == 4 and len(set(decoded)) == 4


def test_cut_off_archives_are_reported(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(encode_record(RECORDS[0]))[:60])
    with pytest.raises(Exception, match="cut off"):
        read_warc(spark, str(tmp_path)).collect()


def test_filters_follow_sql():
    assert holds(EqualTo(("record_type",), "a"), "a") and not holds(EqualTo(("record_type",), "a"), None)
    assert not holds(Not(EqualTo(("record_type",), "a")), None) and holds(Not(EqualTo(("record_type",), "a")), "b")
    assert not holds(Not(In(("record_type",), ("a", None))), "b") and holds(In(("record_type",), ("a", None)), "a")
    assert holds(IsNull(("date",)), None) and holds(Not(IsNull(("date",))), "x")
    assert holds(StringStartsWith(("target_uri",), "ht"), "http")


# -- whitening -----------------------------------------------------------------------------------------------------------


def _matrix(kind, size, rng):
    if kind == "random":
        return rng.standard_normal((size, size))
    if kind == "graded":
        return rng.standard_normal((size, size)) * 10.0 ** -np.arange(size)[None, :]
    if kind == "clustered":
        q, _ = np.linalg.qr(rng.standard_normal((size, size)))
        values = np.repeat([4.0, 4.0 + 1e-13, 2.0, 1.0], -(-size // 4))[:size]
        return np.diag(values) @ q
    if kind == "deficient":
        return rng.standard_normal((size, 2)) @ rng.standard_normal((2, size))
    return np.zeros((size, size)) if kind == "zero" else np.eye(size) * 3


@pytest.mark.parametrize("size", [1, 2, 3, 12, 40])
@pytest.mark.parametrize("kind", ["random", "graded", "clustered", "deficient", "zero", "identity"])
def test_solver_finds_singular_values_and_vectors(kind, size):
    a = _matrix(kind, size, np.random.default_rng(size))
    r = np.linalg.qr(a, mode="r")
    diagonal, super_, v = bidiagonalise(r)
    assert np.allclose(v.T @ v, np.eye(size), atol=1e-13)
    sigma = dqds(diagonal, super_)
    expected = np.linalg.svd(a, compute_uv=False)
    scale = max(expected[0], 1e-300)
    assert np.all(np.abs(sigma - expected) <= 1e-13 * scale)
    vectors = v @ right_vectors(diagonal, super_, sigma, size)
    assert np.abs(vectors.T @ vectors - np.eye(size)).max() < 1e-9
    assert np.abs(a.T @ (a @ vectors) - vectors * sigma**2).max() <= 1e-10 * scale**2


def test_small_singular_values_are_relatively_accurate():
    # Known from the inverse, whose largest singular value is found to full accuracy.
    diagonal, super_ = 10.0 ** -np.arange(0.0, 12.0), 10.0 ** -np.arange(0.5, 11.0)
    b = np.diag(diagonal) + np.diag(super_, 1)
    inverse = np.zeros_like(b)
    for j in range(len(b)):
        for i in range(j, -1, -1):
            inverse[i, j] = ((i == j) - (super_[i] * inverse[i + 1, j] if i < j else 0.0)) / diagonal[i]
    smallest = 1 / np.linalg.norm(inverse, 2)
    assert abs(dqds(diagonal, super_)[-1] / smallest - 1) < 1e-12


VECTORS = np.random.default_rng(5).standard_normal((300, 20)) * np.linspace(0.1, 3, 20)
ROWS = [(n, [float(c) for c in vector], "x", 1) for n, vector in enumerate(VECTORS)]
ODD = [
    (1000, None, "x", 1),
    (1001, [float("nan")] * 20, "x", 1),
    (1002, [float("inf")] + [0.0] * 19, "x", 1),
    (1003, [None] + [0.0] * 19, "x", 1),
    (1004, [], "x", 1),
    (1005, [1.0] * 7, "x", 1),
    (1006, [1e300] * 20, "x", 1),
    (None, ROWS[0][1], "x", 1),
    (0, ROWS[0][1], "x", 1),
]
EMBEDDINGS = "vec_id long, embedding array<double>, component string, n int"


def test_whitening_equals_brute_force(spark):
    rows = whiten(spark.createDataFrame(ROWS + ODD, EMBEDDINGS).repartition(5), components=6).collect()
    kept = ROWS + ODD[-2:]
    assert len(rows) == len(kept) * 6
    x = np.floor(64 * VECTORS).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    by = {}
    for row in rows:
        by.setdefault((row["vec_id"], row["component"]), []).append(row)
    for vec_id, vector, *_ in ROWS:
        own = np.floor(64 * np.array(vector)).astype(int) + 1_000_000
        for component in range(6):
            row = by[vec_id, component + 1][0]
            whitened = (own - sums / n) @ vectors[:, component] / math.sqrt(values[component])
            assert abs(abs(row["whitened"]) - abs(whitened)) < 1e-9
            assert row["n"] == n and int(row["deviation"]) == int(((n * own - sums) ** 2).sum())
            assert abs(row["explained"] / (values[component] / values.sum()) - 1) < 1e-9
            assert row["identity_error"] < 1e-9
    signs = {
        component: {
            np.sign(by[v, component + 1][0]["whitened"] * (x[v] - sums / n) @ vectors[:, component]) for v in range(300)
        }
        for component in range(6)
    }
    assert all(len(sign) == 1 for sign in signs.values())
    assert len(by[0, 1]) == 2 and by[0, 1][0]["whitened"] == by[0, 1][1]["whitened"] == by[None, 1][0]["whitened"]


def test_whitening_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    docs = spark.createDataFrame(ROWS, EMBEDDINGS)
    results = [
        {(r["vec_id"], r["component"]): abs(r["whitened"]) for r in whiten(docs.repartition(n), components=3).collect()}
        for n in (1, 7)
    ]
    assert all(abs(results[0][key] - value) < 1e-9 for key, value in results[1].items())


def test_whitening_of_little(spark):
    nothing = spark.createDataFrame([], EMBEDDINGS)
    assert whiten(nothing).count() == 0 and whiten(spark.createDataFrame(ODD[:3], EMBEDDINGS)).count() == 0
    one = whiten(spark.createDataFrame([ROWS[0]] * 3, EMBEDDINGS)).collect()
    assert len(one) == 48 and all(r["whitened"] is None and r["n"] == 1 and r["deviation"] == 0 for r in one)
    # Two dimensions of three vary, so that the third component has nothing to whiten.
    flat = [(n, [float(n % 5), float(n % 7), 1.0], "x", 1) for n in range(35)]
    rows = whiten(spark.createDataFrame(flat, EMBEDDINGS)).collect()
    assert len(rows) == 35 * 3 and all((r["whitened"] is None) == (r["component"] == 3) for r in rows)
    assert all(r["identity_error"] < 1e-9 for r in rows)


@pytest.mark.parametrize("size", [10, 10**6, 10**9, 10**14])
def test_deviations_are_exact(size):
    rng = np.random.default_rng(3)
    numerators = rng.integers(-size, size, (50, 30))
    expected = [sum(int(v) ** 2 for v in row) for row in numerators]
    assert whitening._deviation(numerators) == expected


def test_query_runs_over_the_whole_table(spark, sf_dir):
    rows = queries.op13_embedding_whitening(spark, sf_dir)
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = rows.agg(F.count("*").alias("n"), F.max("identity_error").alias("error")).first()
    assert found["n"] == table.count() * 16 and found["error"] < 1e-4
    assert dict(rows.dtypes)["deviation"] == "bigint"
