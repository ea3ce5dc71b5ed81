import random

import pytest
import xxhash

from gradewise.llm import queries
from gradewise.llm.simhash import (
    components,
    fingerprint_of,
    keep_one_per_group,
    links,
    near_copies,
    ring_keys,
    similar_groups,
)
from gradewise.llm.text import LOWER, UPPER
from helpers import TRICKY, documents

SF_DIR = "/root/testdata/sf0.001"
FOLD = str.maketrans(UPPER, LOWER)
SPACE = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})


def slow_fingerprint(text):
    words = [w for w in (text or "").translate(FOLD).translate(SPACE).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def brute_force(rows):
    prints = [(key, slow_fingerprint(text)) for key, text, *_ in rows]
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 3:
                root[find(i)] = find(j)
    members = {}
    for i, (key, _) in enumerate(prints):
        members.setdefault(find(i), []).append(key)
    smallest = {r: min((k for k in keys if k is not None), default=None) for r, keys in members.items()}
    return sorted(str((key, signed(fp), smallest[find(i)])) for i, (key, fp) in enumerate(prints))


def found(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_fingerprints_of_short_and_odd_texts():
    for text in ["", "  \n", "one", "One TWO", "a b c", "É Ü   ß", "x " * 1_000, *[t for _, t, *_ in TRICKY]]:
        assert fingerprint_of((text or "").encode()) == slow_fingerprint(text)


def test_tricky_rows_equal_brute_force(tricky):
    assert found(near_copies(tricky)) == brute_force(TRICKY)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    rows = queries.op10_simhash(spark, SF_DIR).collect()
    ours = sorted(str((r.doc_id, signed(int(r.fingerprint, 16)), r.component_id)) for r in rows)
    assert ours == brute_force([(r.doc_id, r.text) for r in docs])


@pytest.fixture(scope="module")
def values():
    """Random fingerprints, chains of near ones around some of them, and a crowd around one."""
    rng = random.Random(5)
    out = [rng.getrandbits(64) for _ in range(150)]
    for centre in out[:25]:
        at = centre
        for _ in range(4):
            for _ in range(rng.randint(1, 4)):
                at ^= 1 << rng.randrange(64)
            out.append(at)
    for _ in range(60):
        at = out[0]
        for _ in range(rng.randint(0, 2)):
            at ^= 1 << rng.randrange(64)
        out.append(at)
    return sorted(set(out))


def near_pairs(values):
    return {
        tuple(sorted((signed(a), signed(b))))
        for i, a in enumerate(values)
        for b in values[:i]
        if (a ^ b).bit_count() <= 3
    }


def test_no_link_is_lost(spark, values):
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    assert {tuple(r) for r in links(fps).collect()} == near_pairs(values)


def test_crowded_keys_connect_the_same(spark, values):
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    some = {tuple(r) for r in links(fps, crowd=3).collect()}
    assert some <= near_pairs(values)
    edges = spark.createDataFrame(sorted(near_pairs(values)), "a long, b long")
    ours = spark.createDataFrame(sorted(some), "a long, b long")
    assert found(components(ours)) == found(components(edges))


def test_every_near_pair_shares_a_key(spark):
    rng, rows = random.Random(9), []
    for _ in range(300):
        a = b = rng.getrandbits(64)
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        rows.append((signed(a), signed(b)))
    df = spark.createDataFrame(rows, "a long, b long")
    assert df.select(ring_keys(df.a).alias("x"), ring_keys(df.b).alias("y")).filter("NOT arrays_overlap(x, y)").count() == 0


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(500, 501)], "a long, b long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert all(roots[i] == 0 for i in range(1, 201)) and roots[501] == 500


def test_one_document_of_each_group_stays(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(5, base, "en", "a"), (3, base + " tail", "en", "b"), (4, base, "en", "a"), (9, "quite another", "en", "a")]
    kept = keep_one_per_group(documents(spark, rows, component_id=1))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 9]
    assert kept.columns == documents(spark, rows, component_id=1).columns


def test_an_empty_table_gives_an_empty_one(nothing):
    assert near_copies(nothing).count() == 0
    assert similar_groups(nothing).count() == 0
    assert keep_one_per_group(nothing).count() == 0


def slow_similar(rows, similarity=0.8):
    def shingles(text):
        words = [w for w in (text or "").translate(FOLD).translate(SPACE).split(" ") if w]
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets, root = [shingles(text) for _, text, *_ in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) / len(a | b) >= similarity:
                root[find(i)] = find(j)
    members = {}
    for i, (key, *_) in enumerate(rows):
        members.setdefault(find(i), []).append(key)
    smallest = {r: min((k for k in keys if k is not None), default=None) for r, keys in members.items()}
    return sorted(str((key, smallest[find(i)])) for i, (key, *_) in enumerate(rows))


def test_similar_groups_equal_brute_force(spark, tricky):
    assert found(similar_groups(tricky)) == slow_similar(TRICKY)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert found(similar_groups(docs)) == slow_similar([(r.doc_id, r.text) for r in docs.collect()])


def test_edited_copies_are_found_and_others_left_alone(spark):
    rng, rows = random.Random(12), []
    for group in range(60):
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(rng.randint(60, 400))]
        rows.append((10 * group, " ".join(words), "en", "a"))
        for copy in range(1, 5):
            edited = list(words)
            for place in rng.sample(range(len(words)), copy * len(words) // 100):
                edited[place] = "changed"
            rows.append((10 * group + copy, " ".join(edited), "en", "a"))
    docs = documents(spark, rows)
    assert found(similar_groups(docs)) == slow_similar(rows)
    kept = {r.doc_id for r in keep_one_per_group(docs, similarity=0.8).collect()}
    assert {10 * group for group in range(60)} <= kept
    assert not kept & {10 * group + 1 for group in range(60)}  # one word in a hundred is edited


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(13)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(300)]
    rows = []
    for i in range(1_500):
        own = list(words)
        own[rng.randrange(300)] = f"own{i}"
        rows.append((i, " ".join(own), "en", "a"))
    assert {r.component_id for r in similar_groups(documents(spark, rows)).collect()} == {0}


def test_copies_unlike_each_other_meet_in_their_original(spark):
    rng, rows = random.Random(17), []
    for group in range(4):
        words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(200)]
        rows.append((100 * group + 50, " ".join(words), "en", "a"))
        for copy in range(30):
            edited = list(words)
            for place in rng.sample(range(5, 195, 6), 4):
                edited[place] = f"own{copy}"
            rows.append((100 * group + copy, " ".join(edited), "en", "a"))
    groups = found(similar_groups(documents(spark, rows)))
    assert groups == slow_similar(rows)
    assert {eval(row)[1] for row in groups} == {0, 100, 200, 300}
