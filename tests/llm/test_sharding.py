import zlib
from collections import defaultdict

import pytest

from gradewise.llm import queries
from gradewise.llm.sharding import END, find_splitters, shard_documents
from helpers import TRICKY, documents

SF_DIR = "/root/testdata/sf0.01"


def nearest(keys, n_shards):
    """By sorting: for each wanted end the least distance that any cut between keys has."""
    keys = sorted(keys)
    total = sum(size for _, size in keys)
    ends, below = [0], 0
    for i, (key, size) in enumerate(keys):
        below += size
        if i + 1 == len(keys) or keys[i + 1][0] != key:
            ends.append(below)
    return total, [min(abs(total * j / n_shards - e) for e in ends) for j in range(1, n_shards)]


@pytest.mark.parametrize("hot", [0, 400])
def test_ends_are_as_near_as_the_tolerance_asks(spark, hot):
    keys = [(f"{zlib.crc32(str(i).encode()):08x}" * 4, 10 + i % 90) for i in range(2_000)]
    keys += [("7" * 16 + f"{zlib.crc32(str(i).encode()):08x}" * 2, 50) for i in range(hot)]
    splitters = find_splitters(spark.createDataFrame(keys, "key string, size long"), 8, tolerance=0.002)
    total, best = nearest(keys, 8)
    for j, (splitter, least) in enumerate(zip(splitters, best), 1):
        off = abs(sum(size for key, size in keys if key < splitter) - total * j / 8)
        assert off <= max(least, 0.002 * total / 8)


def test_one_key_cannot_be_cut(spark):
    keys = spark.createDataFrame([("a" * 32, 5)] * 10, "key string, size long")
    assert set(find_splitters(keys, 4)) == {"a" * 32, "a" * 32 + END}


def test_query_balances_bytes_and_numbers_rows(spark):
    placed = queries.op5_sharding(spark, SF_DIR).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in placed) == sorted(docs)
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in placed:
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert sorted(sizes) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    longest = max(len(t.encode()) for t in docs.values())
    assert max(sizes.values()) - min(sizes.values()) <= 2 * longest


def test_cells_of_many_rows_are_cut_further(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i}", "en", "a") for i in range(3_000)]
    docs = documents(spark, rows)
    fine = {r.doc_id: (r.shard, r.slot) for r in shard_documents(docs, 4, cell_rows=50).collect()}
    plain = {r.doc_id: (r.shard, r.slot) for r in shard_documents(docs, 4).collect()}
    assert fine == plain
    for shard in range(4):
        own = [(slot, len(rows[i][1]) + 1) for i, (s, slot) in fine.items() if s == shard]
        assert sorted(slot for slot, _ in own) == list(range(len(own)))
        assert sum(size for _, size in own) == pytest.approx(sum(len(r[1]) + 1 for r in rows) / 4, rel=0.01)


def test_tricky_rows_keep_their_columns(tricky):
    placed = shard_documents(tricky, 4)
    assert placed.columns == [c for c in tricky.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    assert sorted(str(r.doc_id) for r in placed.collect()) == sorted(str(r[0]) for r in TRICKY)


def test_an_empty_table_gives_an_empty_one(nothing):
    assert shard_documents(nothing).count() == 0
