"""Operators 8 and 9, the pipeline, and how the queries are registered."""

import random
import zlib
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from duskwatch.llm.quality import FEATURES, fit, keep_good, score_documents, text_statistics, train
from duskwatch.llm.queries import ORACLES, QUERIES
from duskwatch.llm.shuffle_shards import number_rows, permute_rows, shard_documents
from tests.llm.brute import fingerprint, kept_words, letter_words

SCHEMA = "doc_id bigint, text string"
SF = "/root/testdata/sf0.001"


def corpus(n=600):
    pick = random.Random(5)
    rows, labels = [], []
    for k in range(n):
        words = ["".join(pick.choices("abcdefgh", k=pick.randint(2, 8))) for _ in range(pick.randint(20, 80))]
        good = k % 4 != 0
        text = ". ".join(" ".join(words[i:i + 8]).capitalize() for i in range(0, len(words), 8)) + "." if good else " | ".join(w + "###" for w in words)
        rows.append((k, text))
        labels.append((k, int(good)))
    return rows, labels


def test_classifier_on_held_out_rows(spark):
    rows, labels = corpus()
    rows += [(9000, None), (9001, ""), (3, "a repeated row"), (None, "no id"), (9002, "long " * 100_000)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as _letters", "2 as score")
    marks = spark.createDataFrame(labels + [(1, None), (77_777, 1), (None, 0)], "doc_id bigint, quality int")
    got = score_documents(docs, marks).toPandas()
    assert len(got) == len(rows) and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    known = got.dropna(subset=["doc_id"])
    assert (known.held_out == [zlib.crc32(str(int(d)).encode()) % 5 == 0 for d in known.doc_id]).all()
    held = known[known.held_out & (known.doc_id < 600)]
    assert (held.predicted == (held.doc_id % 4 != 0)).mean() > 0.98
    kept = keep_good(docs, marks)
    assert kept.columns == docs.columns and kept.count() == int(got.predicted.sum())
    assert score_documents(docs.limit(0), marks).count() == 0
    flat = score_documents(docs, marks.limit(0)).select("score").distinct().collect()
    assert [r["score"] for r in flat] == [0.5]


def test_model_never_sees_held_out_labels_and_is_sparse(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    turned = [(d, 1 - q if zlib.crc32(str(d).encode()) % 5 == 0 else q) for d, q in labels]
    one, two = (train(docs, spark.createDataFrame(x, "doc_id bigint, quality int")) for x in (labels, turned))
    assert one == two and 0 < len(one.rules) < 100
    assert len(train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"), max_rows=50).rules) >= 0


def test_compiled_score_equals_the_rules(spark):
    gen = np.random.default_rng(1)
    x = gen.normal(size=(400, len(FEATURES)))
    model = fit(x, ((x[:, 0] > 0) & (x[:, 3] < 0.5)).astype(float))
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x], [f"_{f}" for f in FEATURES])
    got = np.array([r[0] for r in frame.select(model.column()).collect()])
    margin = np.full(len(x), model.intercept)
    for rule, weight in model.rules:
        holds = np.all([(x[:, f] <= t) if low else (x[:, f] > t) for f, low, t in rule], axis=0)
        margin += weight * holds
    assert np.allclose(got, 1 / (1 + np.exp(-margin)))


def test_statistics_of_odd_texts():
    for text in (b"", b" ", b"\n\n", "é".encode(), b"A!" * 1000):
        values = text_statistics(text)
        assert len(values) == len(FEATURES) and np.isfinite(values).all()


@pytest.mark.parametrize("n", [0, 1, 2, 7, 64, 101, 1000])
def test_permutation(spark, n):
    rows = spark.range(n).withColumnRenamed("id", "row")
    got = [r["image"] for r in permute_rows(rows, n, 42).orderBy("row").collect()]
    assert sorted(got) == list(range(n))
    if n == 1000:
        assert got == [r["image"] for r in permute_rows(rows.repartition(3), n, 42).orderBy("row").collect()]
        assert got != [r["image"] for r in permute_rows(rows, n, 43).orderBy("row").collect()]
        assert abs(np.corrcoef(got, range(n))[0, 1]) < 0.2


def test_shards(spark):
    rows = [(k, "t" * (k % 50) + "é") for k in range(300)] + [(5, None)] * 40 + [(None, ""), (5, "")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as row", "2 as _mid").repartition(6)
    got = shard_documents(docs).toPandas()
    text = lambda t: (t or "").encode()
    key = lambda d, s, c: (-1 if d is None or d != d else int(d), s, c)
    assert sorted(key(d, len(text(t)) + 1, zlib.crc32(text(t))) for d, t in rows) == sorted(map(key, got.doc_id, got["size"], got.text_crc32))
    counts = got.groupby("shard").size()
    assert counts.max() - counts.min() <= 1 and len(counts) == 8
    for _, group in got.groupby("shard"):
        assert sorted(group.slot) == list(range(len(group)))
    assert set(got.law) == {"rows"} and got.grown_shard.isna().all()
    again = shard_documents(docs.repartition(2)).toPandas()
    place = lambda f: f.sort_values(["doc_id", "text_crc32", "shard", "slot"])[["doc_id", "shard", "slot"]].values.tolist()
    assert str(place(got)) == str(place(again))
    assert shard_documents(docs.limit(0)).count() == 0


def test_shards_use_no_python(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    plan = shard_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_row_numbers_follow_the_order(spark):
    rows, n = number_rows(spark.range(500).selectExpr("id % 3 as k", "id"), "k")
    found = sorted((r["row"], r["k"]) for r in rows.collect())
    assert n == 500 and [r for r, _ in found] == list(range(500)) and [k for _, k in found] == sorted(k for _, k in found)


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")
def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "substring_dedup", "decontaminate", "packing"]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = stages["quality"](spark, docs, SF)
    bad = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    kept = {r["doc_id"] for r in good.collect()}
    assert good.columns == docs.columns and len(kept & bad) <= len(bad) / 2 and len(kept) > 0.7 * len(rows)

    one = stages["near_dedup"](spark, docs, SF)
    prints, first = {d: fingerprint(t) for d, t in rows.items()}, {}
    for d in sorted(rows):
        near = [first[e] for e in first if (prints[d] ^ prints[e]).bit_count() <= 2]
        first[d] = min(near, default=d)
        for e, f in list(first.items()):
            if f in near:
                first[e] = first[d]
    assert one.columns == docs.columns and {r["doc_id"] for r in one.collect()} == set(first.values())

    cut = stages["substring_dedup"](spark, docs, SF)
    want = {d: b" ".join(k) for (d, _), k in zip(rows.items(), kept_words(list(rows.items()), 13))}
    got = {r["doc_id"]: b" ".join((r["text"] or "").encode().split()) for r in cut.collect()}
    assert cut.columns == docs.columns and got == {d: k for d, k in want.items() if k}

    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        words = letter_words(r["text"])
        windows |= {tuple(words[i:i + 10]) for i in range(max(1, len(words) - 9))} if words else set()
    clean = {d for d, t in rows.items() for words in [letter_words(t)]
             if not any(tuple(words[i:i + n]) in windows for n in {len(w) for w in windows} for i in range(len(words) - n + 1))}
    out = stages["decontaminate"](spark, docs, SF)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == clean

    packed = corpus_pipeline.run(spark, SF).toPandas()
    assert 0 < packed.doc_id.nunique() < len(rows)
    assert packed.groupby("sequence_id").length.sum().max() <= 2048


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")
def test_registered(spark):
    import __spark_entry__ as entry
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(ORACLES) <= set(QUERIES) <= set(names)
