from collections import Counter, defaultdict

import pytest
from helpers import TRICKY, documents
from test_decontamination import brute_force as slow_leaks
from test_simhash import slow_similar as slow_groups

import __spark_entry__ as spark_entry
import corpus_pipeline
from gradewise.llm.quality import score_documents

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage returns, written and read again."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "rows")
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def rows(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]


def test_stages_are_the_dealt_ones(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "near-dedup", "decontamination", "mixing", "sharding",
    ]
    columns = stages["documents"].columns
    assert all(stages[n].columns == columns for n, _ in corpus_pipeline.STAGES[:-1])
    assert stages["sharding"].columns == [*columns, "shard", "slot"]


def test_quality_drops_what_scores_low(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = score_documents(stages["documents"], labels).collect()
    kept = {r.doc_id for r in scored if r.score >= corpus_pipeline.QUALITY}
    assert {r[0] for r in rows(stages["quality classifier"])} == kept


def test_one_of_each_near_copy_stays(stages):
    before = rows(stages["quality classifier"])
    own = [eval(line) for line in slow_groups(before)]
    assert {r[0] for r in rows(stages["near-dedup"])} == {key for key, smallest in own if key == smallest}


def test_leaks_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    found = [eval(line) for line in slow_leaks(rows(stages["near-dedup"]), items)]
    assert {r[0] for r in rows(stages["decontamination"])} == {key for key, _, n_hit, _ in found if n_hit == 0}


def test_mix_takes_words_of_the_documents(stages):
    before = {key: Counter(text.split()) for key, text, *_ in rows(stages["decontamination"])}
    taken = defaultdict(Counter)
    for key, text, *_ in rows(stages["mixing"]):
        taken[key] += Counter(text.split())
    assert all(n <= 2 * before[key][word] for key, words in taken.items() for word, n in words.items())
    total = sum(sum(words.values()) for words in before.values())
    assert sum(sum(words.values()) for words in taken.values()) == pytest.approx(1.5 * total, rel=0.02)


def test_shards_hold_the_mix(stages):
    placed = stages["sharding"]
    assert Counter(rows(placed)) == Counter(rows(stages["mixing"]))
    slots = defaultdict(list)
    for r in placed.collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots) <= 15


def test_run_is_all_stages(spark, stages):
    assert "pipeline" in spark_entry.queries() and "pipeline" not in spark_entry.oracle_sql()
    found = corpus_pipeline.run(spark, SF_DIR)
    key = lambda r: (r.doc_id, r.text, r.shard, r.slot)
    assert Counter(map(key, found.collect())) == Counter(map(key, stages["sharding"].collect()))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_and_empty_tables(spark, tricky, nothing, name, stage):
    out = stage(spark, tricky, SF_DIR)
    assert set(tricky.columns) <= set(out.columns)
    assert out.count() >= 0
    assert stage(spark, nothing, SF_DIR).count() == 0


def test_clean_documents_pass_the_filters(spark):
    clean = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    good = [r for r in clean if labels.get(r[0]) == 1]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, SF_DIR).collect()}
    assert sum(r[0] in kept for r in good) / len(good) > 0.95
    assert len(documents(spark, TRICKY).columns) == 5
