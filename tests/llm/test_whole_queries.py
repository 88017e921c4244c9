"""The registered corpus queries over whole tables: against SQL where there is one, else against plain Python."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from adpulse.llm import oracles, queries
from adpulse.llm.decontaminate import Settings, find_leaks
from adpulse.llm.order import permute, write_in_training_order
from adpulse.llm.queries import ORDER_KEY, tokenizer_path


@pytest.mark.parametrize("name", [name for name in oracles.ORACLES if name not in ("op11_importance_resampling", "op12_warc")])
def test_query_equals_sql(spark, sf_dir, name):
    ours = compare.spark_result(queries.queries()[name](spark, sf_dir))
    assert compare.difference(ours, compare.duckdb_result(compare.connect(sf_dir), oracles.ORACLES[name])) is None


@pytest.fixture(scope="module")
def documents(spark):
    from conftest import SF_DIR

    return spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()


@pytest.fixture(scope="module")
def token_ids(documents):
    tokenizer = Tokenizer.from_file(str(tokenizer_path()))
    return {row["doc_id"]: [*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 1] for row in documents}


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_over_the_whole_table(spark, sf_dir, token_ids):
    rows = queries.op6_best_fit_packing(spark, sf_dir).collect()
    expected = {
        (doc_id, at // 4096, at, len(ids[at : at + 4096]), _crc(ids[at : at + 4096]))
        for doc_id, ids in token_ids.items()
        for at in range(0, len(ids), 4096)
    }
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == expected and len(rows) == len(expected)
    places = defaultdict(list)
    for row in rows:
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    for spans in places.values():
        assert [at for at, _ in sorted(spans)] == np.cumsum([0, *(n for _, n in sorted(spans))])[:-1].tolist()
        assert sum(n for _, n in spans) <= 4096
    least = -(-sum(map(len, token_ids.values())) // 4096)
    assert least <= len(places) <= least + max(2, least // 50)


def test_training_order_over_the_whole_table(spark, sf_dir, token_ids):
    rows = queries.op8_training_order(spark, sf_dir).collect()
    expected = Counter(
        (doc_id, at, len(ids[at : at + 512]), _crc(ids[at : at + 512])) for doc_id, ids in token_ids.items() for at in range(0, len(ids), 512)
    )
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    assert sorted(r["slot"] for r in rows) == list(range(len(rows))) and all(r["intact"] and r["stride"] == 1024 for r in rows)
    assert sorted(permute(np.arange(len(rows)), len(rows), ORDER_KEY).tolist()) == list(range(len(rows)))


def test_a_reader_goes_on_from_any_slot(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    shards = write_in_training_order(docs, tokenizer_path(), key=3, shard_sequences=16)
    whole = {r["slot"]: bytes(r["payload"]) for r in shards.read(spark).collect()}
    part = shards.read(spark, 21, 30)
    assert {r["slot"]: bytes(r["payload"]) for r in part.collect()} == {slot: whole[slot] for slot in range(21, 51)}
    assert part.select("shard").distinct().count() == 3
    # Without Spark: one seek, then every stride is a sequence.
    path, at = shards.locate(spark, 21)
    with open(path.removeprefix("file://"), "rb") as source:
        source.seek(at)
        for slot in range(21, 32):
            assert source.read(shards.stride) == whole[slot]
        assert source.read() == b""


def test_slots_do_not_depend_on_the_partitioning(spark, tmp_path):
    from adpulse.session import session_conf

    rng = random.Random(3)
    rows = [(n // 2, " ".join(rng.choices(["alpha", "beta", "gamma"], k=rng.randrange(30)))) for n in range(300)] + [(None, "x"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.repartition(3).write.parquet(f"{tmp_path}/docs")

    def slots(table):
        index = write_in_training_order(table, tokenizer_path(), key=5, sequence_tokens=8, shard_sequences=64).index(spark)
        return sorted(tuple(r) for r in index.drop("file").collect())

    in_files = spark.read.parquet(f"{tmp_path}/docs")
    whole = slots(in_files)
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1"}):
        assert slots(in_files) == whole
    assert slots(docs.repartition(2)) == slots(docs.repartition(7)) == slots(docs.coalesce(1))
    assert len(whole) == len(slots(docs)) and [row[0] for row in whole] == list(range(len(whole)))


# -- decontamination ---------------------------------------------------------------------------------------------------


def _leaks(docs, items, settings):
    """BM25 of every passage against every item, then the overlaps, in plain Python."""
    count = len(items)
    items = [(n, text.split()) for n, text in items if text and text.split()]
    df = Counter(word for _, words in items for word in set(words))
    mean = max(1.0, sum(len(words) for _, words in items) / count)
    idf = {word: math.log(1 + (count - n + 0.5) / (n + 0.5)) for word, n in df.items()}
    impacts = []
    for _, words in items:
        tf = Counter(words)
        own = {w: idf[w] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(words) / mean)) for w, n in tf.items()}
        total = sum(own.values())
        impacts.append({w: value / total for w, value in own.items()})
    width = max([settings.passage_words, *(2 * len(words) for _, words in items)])
    stride = width // 2

    def share(part, around):
        size = settings.shingle_words
        if len(part) < size:
            return float(set(part) <= set(around))
        own = {tuple(part[i : i + size]) for i in range(len(part) - size + 1)}
        return len(own & {tuple(around[i : i + size]) for i in range(len(around) - size + 1)}) / len(own)

    found = set()
    for doc_id, text in docs:
        words = (text or "").split()
        for start in range(0, max(1, len(words)), stride):
            passage = set(words[start : start + width])
            for (item, terms), own in zip(items, impacts):
                if sum(value for word, value in own.items() if word in passage) < settings.threshold - 1e-9:
                    continue
                around = words[max(0, start - len(terms)) : start + width + len(terms)]
                cut = len(terms) - settings.answer_words if len(terms) > 2 * settings.answer_words else len(terms)
                question, answer = share(terms[:cut], around), share(terms[cut:] or terms, around)
                if question >= settings.question_overlap and answer >= settings.answer_overlap:
                    found.add((doc_id, item))
    return found


def _benchmark(rng, words):
    items = [(n, " ".join(rng.choices(words, k=rng.randrange(6, 60)))) for n in range(40)] + [(90, None), (91, ""), (92, "w1 w2")]
    docs = []
    for n in range(160):
        body = rng.choices(words, k=rng.randrange(0, 500))
        if n % 3 == 0:  # whole items, their ends, and edited copies
            item = rng.choice(items[:40])[1].split()
            kept = item if n % 2 else item[len(item) // 3 :]
            kept = [w if rng.random() > (0.1 if n % 5 == 0 else 0) else rng.choice(words) for w in kept]
            at = rng.randrange(len(body) + 1)
            body[at:at] = kept
        docs.append((n, " ".join(body)))
    return items, [*docs, (900, None), (901, "")]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("index_bytes", [8_000_000, 300])
def test_leaks_equal_brute_force(spark, seed, index_bytes):
    """Also where the benchmark is cut into many small indexes: scores come from the whole of it."""
    rng = random.Random(seed)
    items, docs = _benchmark(rng, [f"w{n}" for n in range(150)])
    settings = Settings(passage_words=120)  # as wide as the longest item asks for, in every block
    tables = [
        spark.createDataFrame([(*row, "x", 1.0) for row in rows], f"{key} long, text string, {clash} string, score double").repartition(3)
        for rows, key, clash in ((docs, "doc_id", "item_id"), (items, "item_id", "doc_id"))
    ]
    found = find_leaks(*tables, settings, index_bytes).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    expected = _leaks(docs, items, settings)
    assert len(expected) > 20 and got == expected
    assert all(r["score"] >= 0.5 - 1e-9 for r in found)


# -- pipeline ----------------------------------------------------------------------------------------------------------


def test_pipeline_from_end_to_end(spark, sf_dir, token_ids):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept, sizes = docs.columns, docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in kept.collect()}
        kept = stage(spark, kept, sf_dir).cache()
        after = {r["doc_id"]: r["text"] for r in kept.collect()}
        sizes.append(len(after))
        assert kept.columns == columns and set(after) < set(before), name
        if name != "lines":
            assert all(before[doc_id] == text for doc_id, text in after.items())
        else:
            assert any(before[doc_id] != text for doc_id, text in after.items())
            for doc_id, text in after.items():  # lines go, none is changed
                rest = iter((before[doc_id] or "").split("\n"))
                assert all(line in rest for line in (text or "").split("\n"))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [doc_id for doc_id, quality in labels.items() if quality == 1]
    kept_by_quality = {r["doc_id"] for r in corpus_pipeline.STAGES[0][1](spark, docs, sf_dir).select("doc_id").collect()}
    assert sum(doc_id in kept_by_quality for doc_id in good) >= 0.98 * len(good)
    last = {r["doc_id"]: r["text"] for r in kept.collect()}
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == set(last)
    tokenizer = Tokenizer.from_file(str(tokenizer_path()))
    lengths = Counter()
    for row in packed:
        lengths[row["doc_id"]] += row["length"]
    assert lengths == {d: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in last.items()}


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_empty_and_odd_tables(spark, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row_key string, score double, rank_id int"
    odd = [
        (None, None, None, None, None, None, None, None),
        (1, None, "en", None, -5, "k", 0.5, 1),
        (1, "", None, "s", None, "k", 0.5, 1),
        (2, "a b c\n\n" * 2000, "en", "s", 1, "k", 0.5, 1),
        (2, "a b c\n\n" * 2000, "en", "s", 1, "k", 0.5, 1),
        (3, "ordinary words of a text that is neither long nor short, in one line.", "en", "s", 70, "k", 0.5, 1),
    ]
    rows = stage(spark, spark.createDataFrame(odd, schema), sf_dir)
    nothing = stage(spark, spark.createDataFrame([], schema), sf_dir)
    assert rows.columns == nothing.columns and nothing.count() == 0
    if name != "packing":
        assert rows.columns == [part.split()[0] for part in schema.split(", ")]
        assert 3 in {r["doc_id"] for r in rows.collect()}
    else:
        assert rows.groupBy("doc_id").count().count() == 4


def test_shards_are_written_in_rounds(spark, sf_dir, monkeypatch):
    """Only a part of the sequences is dealt by a shuffle at a time, and every number of rounds gives the same rows."""
    from adpulse.llm import order

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)

    def rows():
        shards = write_in_training_order(docs, tokenizer_path(), key=3, shard_sequences=16)
        listed = shards.read(spark)
        return sorted(tuple(r) for r in listed.drop("file").collect()), len(listed.select("file").distinct().collect())

    several = rows()
    monkeypatch.setattr(order, "ROUNDS_OF_SHARDS", 1)
    assert several == rows() and several[1] > 2
    monkeypatch.setattr(order, "ROUNDS_OF_SHARDS", 1000)
    assert several == rows()
