import zlib

import numpy as np
import pytest
from helpers import TRICKY, documents

from gradewise.llm import queries
from gradewise.llm.quality import (
    DIMS,
    GATHERED,
    WINDOW,
    WordVectors,
    best_temperature,
    common_words,
    drop_low_quality,
    fit_network,
    fit_quality,
    index_vectors,
    labelled_sample,
    pooled,
    score_documents,
    sigmoid,
    word_vectors,
    words_of,
)

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_rows_are_scored_well(spark):
    rows = queries.op7_quality(spark, SF_DIR).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(judged) > 50 and np.mean([p == y for p, y in judged]) > 0.9


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 4 = 2, 1 - quality, quality) AS quality")
    one, two = (fit_quality(docs, x) for x in (labels, flipped))
    assert all(np.array_equal(a, b) for a, b in zip(one.layers, two.layers)) and one.temperature == two.temperature


def slow_contexts(own):
    """Per place the sum of the index vectors around it."""
    index = index_vectors(own).astype(float)
    return [
        sum((index[j] for j in range(max(0, i - WINDOW), min(len(own), i + WINDOW + 1)) if j != i), np.zeros(DIMS))
        for i in range(len(own))
    ]


def test_word_vectors_equal_brute_force(spark):
    texts = [t for _, t, *_ in TRICKY if t and len(t) < 200] + ["the cat and the dog and the end"] * 3
    sums, n = {}, {}
    for text in texts:
        own = words_of(text.encode())
        for word, context in zip(own.tolist(), slow_contexts(own)):
            sums[word], n[word] = sums.get(word, 0) + context, n.get(word, 0) + 1
    total = sum(n.values())
    mean = sum(sums.values()) / total
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    for common in (20, 1 << 16):
        table = word_vectors(docs, common=common)
        assert table.words.tolist() == sorted(w for w in n if n[w] * common >= total)
        assert len(table.words) <= common and np.allclose(table.mean, mean)
        for word, vector in zip(table.words.tolist(), table.vectors):
            apart = sums[word] / n[word] - mean
            assert np.allclose(vector, apart / max(np.linalg.norm(apart), 1e-9), atol=1e-5)


def test_rare_words_have_the_context_of_their_place(spark):
    docs = spark.createDataFrame([("a b c d e a b c",), ("x a b",), ("rare a b",)], "text string")
    table = word_vectors(docs, common=5)  # a, b: three and more of 14
    assert len(table.words) == 2
    own = words_of(b"a rare b c a")
    contexts = slow_contexts(own)
    for word, vector, context in zip(own.tolist(), table.of(own), contexts):
        if word in table.words:
            assert np.allclose(vector, table.vectors[np.searchsorted(table.words, np.uint64(word))])
        else:
            apart = context - table.mean
            assert np.allclose(vector, apart / np.linalg.norm(apart), atol=1e-5)


def test_no_two_of_many_words_share_a_vector_source():
    text = " ".join(f"word{i}" for i in range(300_000)).encode()
    assert len(np.unique(words_of(text))) == 300_000
    nothing_common = WordVectors(np.zeros(0, np.uint64), np.zeros((0, DIMS), np.float32), np.zeros(DIMS))
    assert pooled(text, nothing_common)[2 * DIMS + 1] == 1  # all of them distinct


def test_pooling_handles_empty_and_long_texts(spark):
    docs = spark.createDataFrame([("one two !! three",), ("two one",)], "text string")
    table = word_vectors(docs, common=4)
    assert 0 < len(table.words) < 4 and not pooled(b"", table).any()
    text = b"one two !! three " * 60_000
    own = table.of(words_of(text)).astype(np.float64)
    assert len(own) > 2 * GATHERED
    found = pooled(text, table)
    assert np.allclose(found[:DIMS], own.mean(0), atol=1e-4)
    assert np.allclose(found[DIMS : 2 * DIMS], own.std(0), atol=1e-3)
    alike, distinct, count = found[2 * DIMS :]
    assert alike == pytest.approx((own[:-1] * own[1:]).sum() / len(own), rel=1e-4)
    assert (distinct, count) == (4 / len(own), np.log1p(len(own)))


def test_common_words_of_an_empty_table(nothing):
    assert len(common_words(nothing)) == 0


def test_network_learns_what_no_line_can_part():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2_000, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    w1, b1, w2, b2 = fit_network(x, y)
    assert np.mean((np.tanh(x @ w1 + b1) @ w2 + b2 > 0) == y) > 0.95


def test_temperature_is_found_again():
    rng = np.random.default_rng(3)
    true = rng.normal(size=40_000) * 2
    y = (rng.random(40_000) < sigmoid(true)).astype(float)
    for factor in (3, 1, 1 / 3):
        assert best_temperature(true * factor, y) == pytest.approx(factor, rel=0.1)


def test_temperature_of_classes_parted_without_a_fault_is_inside_the_range():
    logits = np.repeat([-2.0, 2.0], 30)
    assert np.exp(-3) < best_temperature(logits, (logits > 0).astype(float)) < 1


def test_scores_of_overlapping_classes_are_calibrated(spark):
    """On rows kept out of the fit, bins of scores hold about as many ones as they say."""
    rng = np.random.default_rng(4)
    good, bad = ([f"{kind}{i}" for i in range(40)] for kind in ("fine", "poor"))
    rows, labels = [], []
    for i in range(16_000):
        y = int(rng.random() < 0.5)
        picked = rng.random(12) < (0.62 if y else 0.38)
        words = [rng.choice(good if g else bad) for g in picked]
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, y))
    labels_table = spark.createDataFrame(labels, "doc_id bigint, quality int")
    scored = score_documents(documents(spark, rows), labels_table).select("doc_id", "score").collect()
    kept_out = [(r.score, labels[r.doc_id][1]) for r in scored if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    score, y = (np.array(x, float) for x in zip(*kept_out))
    bins = np.minimum((score * 10).astype(int), 9)
    sizes = np.bincount(bins, minlength=10)
    gaps = np.abs(np.bincount(bins, score, 10) - np.bincount(bins, y, 10)) / np.maximum(sizes, 1)
    assert (sizes >= 300).sum() >= 5 and gaps[sizes >= 300].max() < 0.05
    assert (gaps * sizes).sum() / sizes.sum() < 0.03


def test_sample_is_bounded_and_leaves_out_held_out_rows(spark):
    labels = spark.range(5_000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    rows = labelled_sample(labels, "doc_id", "quality", 100).collect()
    assert len(rows) == 100 and all(zlib.crc32(str(r.id).encode()) % 4 != 2 for r in rows)


def test_odd_labels_and_repeated_keys(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, 7), (None, 1), (4, 1)], "doc_id bigint, quality int")
    rows = {r.id: r.y for r in labelled_sample(labels, "doc_id", "quality", 100).collect()}
    held = {i for i in (1, 4) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {k: v for k, v in rows.items() if k is not None} == {k: v for k, v in {1: 0, 4: 1}.items() if k not in held}


def test_tricky_rows_and_one_class(spark, tricky, nothing):
    labels = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id bigint, quality int")
    for known in (labels, labels.filter("false")):
        scores = [r.score for r in score_documents(tricky, known).collect()]
        assert len(scores) == len(TRICKY) and len(set(scores)) == 1 and 0 < scores[0] < 1
    assert score_documents(nothing, labels).count() == 0


def test_filter_keeps_good_rows_as_they_are(spark):
    good = [(i, f"a plain sentence about thing number {i} and its many uses", "en", "a") for i in range(200)]
    bad = [(i, "BUY!!! $$$ NOW### &&& " * (i % 5 + 1), "en", "a") for i in range(200, 400)]
    docs = documents(spark, good + bad, score=1)
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(400)], "doc_id bigint, quality int")
    kept = drop_low_quality(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(200))
