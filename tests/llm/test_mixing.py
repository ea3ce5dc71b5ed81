import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from gradewise.llm.mixing import (
    ROUNDS,
    MixPlan,
    mix_sources,
    mixed_documents,
    permuted,
    source_targets,
)
from gradewise.llm.text import SPACES
from helpers import TRICKY, documents, rows_of

SF_DIR = "/root/testdata/sf0.01"


def words_of(text):
    for space in SPACES:
        text = (text or "").replace(space, " ")
    return [w for w in text.split(" ") if w]


def slow_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Excess over the cap reshared by weight until no target is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = share * sum(sizes.values())
    capped = set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        level = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= over


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 10, "c": 10},
        {"a": 1, "b": 1_000, "c": 5, None: 7},
        {"a": 0, "b": 3},
        {f"s{i}": (i * 37) % 101 for i in range(40)},
        {"only": 9},
    ],
)
def test_targets_equal_repeated_resharing(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r.source: r.target for r in source_targets(table, MixPlan()).collect()}
    assert found == pytest.approx(slow_targets(sizes))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257, 1_000])
def test_permutation_hits_every_number_once(spark, n):
    df = spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(42), F.lit(3)).alias("p"))
    places = [r.p for r in df.collect()]
    assert sorted(places) == list(range(n))
    assert n < 10 or places != list(range(n))


@pytest.fixture(scope="module")
def mixed(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return docs, mix_sources(docs), {r.doc_id: r for r in docs.collect()}


def test_taken_words_follow_from_the_slots(mixed):
    docs, mix, rows = mixed
    taken = {r.id: r for r in mix.taken().collect()}
    assert sorted(taken) == sorted(rows)
    from_slots = defaultdict(int)
    for r in mix.slots().collect():
        from_slots[r.id] += r.n_words
        assert 0 < r.n_words <= mix.plan.block_words and r.first_word + r.n_words <= taken[r.id].size
    assert all(r.taken == from_slots[r.id] <= 2 * r.size for r in taken.values())
    assert all(r.size == len(words_of(rows[r.id].text)) for r in taken.values())


def test_sources_come_near_their_targets(mixed):
    _, mix, _ = mixed
    sums, targets = defaultdict(int), {}
    for r in mix.taken().collect():
        sums[r.source] += r.taken
        targets[r.source] = r.target
    assert all(abs(sums[s] - t) <= 2 * mix.plan.block_words for s, t in targets.items())


def test_blocks_are_full_but_for_the_last(mixed):
    _, mix, _ = mixed
    words = defaultdict(int)
    for r in mix.slots().collect():
        words[r.sid, r.k, r.block] += r.n_words
    last = {}
    for sid, _, block in words:
        last[sid] = max(last.get(sid, 0), block)
    assert all(n == mix.plan.block_words for (sid, _, block), n in words.items() if block < last[sid])


def test_shard_counts_are_spread_like_a_multinomial(mixed):
    _, mix, _ = mixed
    per_shard = Counter()
    for r in mix.counts.collect():
        per_shard[r.shard] += r.blocks
    total = mix.drawn.count()
    assert sum(per_shard.values()) == total
    mean = total / mix.plan.n_shards
    assert max(abs(n - mean) for n in per_shard.values()) < 5 * mean**0.5


def hashed(*values):
    """Spark's hash of values: ("i", 32 bits) or ("q", 64 bits), signed."""
    seed = 42
    for width, value in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<" + width, value), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def slow_place(x, n, seed, sid):
    for r in range(1, ROUNDS + 1):
        partner = ((hashed(("i", r), ("i", seed), ("i", sid)) % n) - x) % n
        if hashed(("i", seed), ("i", sid), ("i", r), ("q", max(x, partner))) % 2 == 0:
            x = partner
    return x


def test_a_redraw_by_brute_force_gives_the_same_mix(mixed):
    """Counts per shard, slots, blocks, and from them the words taken and shards of each document."""
    _, mix, _ = mixed
    plan, counts, drawn = mix.plan, Counter(), {}
    for s in mix.sources.collect():
        n = -(-s.source_size // plan.block_words)
        total = round(n * s.target / s.source_size)
        for k in range(total):
            counts[s.sid, hashed(("i", plan.seed + 1), ("i", s.sid), ("q", k)) % plan.n_shards] += 1
        k = 0
        for shard in range(plan.n_shards):
            for _ in range(counts[s.sid, shard]):
                drawn[s.sid, k] = (shard, k // n, slow_place(k % n, n, plan.seed, s.sid))
                k += 1
    assert {(r.sid, r.shard): r.blocks for r in mix.counts.collect()} == +counts
    assert {(r.sid, r.k): (r.shard, r.epoch, r.block) for r in mix.drawn.collect()} == drawn
    shards_of = defaultdict(list)
    for (sid, _), (shard, _, block) in drawn.items():
        shards_of[sid, block].append(shard)
    expected = {}
    for d in mix.documents.collect():
        words = [shards_of[d.sid, w // plan.block_words] for w in range(d.start, d.start + d.size)]
        shards = {shard for held in words for shard in held}
        expected[d.id] = (sum(map(len, words)), min(shards, default=None), max(shards, default=None))
    found = {r.id: (r.taken, r.first_shard, r.last_shard) for r in mix.taken().collect() if r.size}
    assert found == expected


def test_the_counts_decide_what_the_query_returns(mixed):
    """Other shards for the same totals: other shards in the result, the same words."""
    docs, mix, _ = mixed
    other = mix_sources(docs, MixPlan(n_shards=3))
    ours, theirs = ({r.id: r for r in m.taken().collect()} for m in (mix, other))
    assert {k: r.taken for k, r in ours.items()} == {k: r.taken for k, r in theirs.items()}
    assert max(r.last_shard for r in theirs.values() if r.taken) == 2
    assert max(r.last_shard for r in ours.values() if r.taken) > 2
    assert "shard" in other.taken()._jdf.queryExecution().optimizedPlan().toString()


def test_reruns_and_layouts_agree(mixed):
    docs, mix, _ = mixed
    again = mix_sources(docs.repartition(5))
    assert rows_of(again.taken()) == rows_of(mix.taken())


def test_mixed_documents_hold_the_words_taken(mixed):
    docs, mix, rows = mixed
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    words = defaultdict(int)
    for r in out.collect():
        mine = words_of(r.text)
        words[r.doc_id] += len(mine)
        assert r.n_chars == len(r.text) and set(mine) <= set(words_of(rows[r.doc_id].text))
    assert {k: n for k, n in words.items()} == {r.id: r.taken for r in mix.taken().collect() if r.taken}


def test_tricky_rows(tricky):
    taken = mix_sources(tricky).taken().collect()
    assert sorted(str((r.id, r.size)) for r in taken) == sorted(
        str((key, len(words_of(text)))) for key, text, *_ in TRICKY
    )
    assert all(0 <= r.taken <= 2 * r.size for r in taken)
    assert mixed_documents(tricky).columns == tricky.columns
    assert mixed_documents(tricky).count() > 0


def test_many_draws_are_dealt_out(spark):
    rows = [(i, "some words here " * 40, "en", "big" if i % 3 else "small") for i in range(600)]
    mix = mix_sources(documents(spark, rows), MixPlan(block_words=1))
    assert mix.drawn.count() == pytest.approx(1.5 * 600 * 120, rel=0.001)
    assert mix.drawn.rdd.getNumPartitions() > 1


def test_an_empty_table_gives_an_empty_mix(nothing):
    assert mix_sources(nothing).taken().count() == 0
    assert mixed_documents(nothing).count() == 0


def test_a_very_long_text_is_cut_in_all_its_parts(spark):
    """Hundreds of parts of one text, each with the words its block has of it."""
    long = [f"w{i}" for i in range(200_000)]
    docs = documents(spark, [(1, " ".join(long), "en", "a"), (2, "short text of b", "en", "b")])
    plan = MixPlan(share=0.4)
    kept = mixed_documents(docs, plan).filter("doc_id = 1").collect()
    places = sorted(int(w[1:]) for r in kept for w in words_of(r["text"]))
    slots = mix_sources(docs, plan).slots().filter("id = 1").collect()
    expected = sorted(w for s in slots for w in range(s["first_word"], s["first_word"] + s["n_words"]))
    assert len(slots) > 500
    assert places == expected
