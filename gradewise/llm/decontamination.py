"""Benchmark passages in documents, found with a broadcast set of normalised word n-grams.

The windows of the benchmark are made distinct by Spark and broadcast in pieces of at
most ``max_windows``, a bound on memory whatever the benchmark's size; each piece is one
more scan of the texts within the same task. A document's word windows are hashed by
numpy and looked up in a bit table; every hit is then compared word by word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from gradewise.functions import column
from gradewise.llm.text import fresh, show_code, utf8
from gradewise.sources.scratch import materialize

# Word bytes are digits, a-z after folding, and all bytes from 0x80.
WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)

FACTOR = np.uint64(0x9E3779B97F4A7C15)
TABLE_BITS = 22

HIT = "struct<first:int,last:int,start:int,stop:int>"
LEAKS = f"struct<n_words:bigint,n_hit:bigint,items:array<string>,hits:array<{HIT}>>"
LEAKS_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("hits", pa.list_(pa.struct([(n, pa.int32()) for n in ("first", "last", "start", "stop")]))),
    ]
)


def words_of(raw: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text."""
    return raw.translate(WORDS).split()


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words from the words' own hashes."""
    n = len(hashes) - size + 1
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * FACTOR + hashes[i : i + n]
    return total ^ (total >> np.uint64(31))


def hash_words(words: list[bytes]) -> np.ndarray:
    # Python's own hash: windows and texts meet within one process only.
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64) * FACTOR


#: Windows scanned for at a time; they take some 250 MB of a worker.
MAX_WINDOWS = 400_000


class WindowSet:
    """Benchmark windows, and the bit tables by which texts are looked up in them."""

    def __init__(self, windows: list[tuple[str, list[str]]]):
        self.windows = windows
        self.tables: dict[int, np.ndarray] | None = None

    def __getstate__(self):
        return self.windows

    def __setstate__(self, windows):
        self.__init__(windows)

    def prepare(self) -> None:
        self.items: dict[tuple[bytes, ...], list[str]] = {}
        self.tables = {}
        for text, items in self.windows:
            words = tuple(text.encode().split(b" "))
            self.items[words] = items
            table = self.tables.setdefault(len(words), np.zeros(1 << TABLE_BITS, bool))
            table[window_hashes(hash_words(words), len(words)) >> np.uint64(64 - TABLE_BITS)] = True

    def find(self, words: list[bytes]) -> list[tuple[int, int, list[str]]]:
        """Runs of words that are a window: first word, word after the last, items."""
        if self.tables is None:
            self.prepare()
        found = []
        hashes = hash_words(words) if words and self.tables else None
        for size, table in self.tables.items():
            if len(words) < size:
                continue
            likely = table[window_hashes(hashes, size) >> np.uint64(64 - TABLE_BITS)]
            for i in np.flatnonzero(likely).tolist():
                items = self.items.get(tuple(words[i : i + size]))
                if items is not None:
                    found.append((i, i + size, items))
        return found


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs' union as sorted runs that neither overlap nor touch."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def byte_spans(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where runs of words lie in the UTF-8 text."""
    if not runs:
        return []
    inside = np.frombuffer(raw.translate(WORDS), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, stops = edges[::2], edges[1::2]
    return [(int(starts[a]), int(stops[b - 1])) for a, b in runs]


def _scanner(windows):
    @arrow_udf(LEAKS)
    def scan(texts: pa.Array, before: pa.Array) -> pa.Array:
        rows = []
        for raw, old in zip(utf8(texts), before.to_pylist()):
            words = words_of(raw)
            found = windows.value.find(words)
            items = {i for _, _, own in found for i in own}
            runs = [(a, b) for a, b, _ in found]
            if old is not None:
                items.update(old["items"])
                runs += [(h["first"], h["last"]) for h in old["hits"]]
            runs = merged(runs)
            hits = [
                {"first": a, "last": b, "start": s, "stop": e}
                for (a, b), (s, e) in zip(runs, byte_spans(raw, runs))
            ]
            n_hit = sum(b - a for a, b in runs)
            rows.append({"n_words": len(words), "n_hit": n_hit, "items": sorted(items), "hits": hits})
        return pa.array(rows, LEAKS_ARROW)

    return scan.asNondeterministic()  # else filters on its result run it twice


def _windows_udf(size: int):
    @arrow_udf("array<string>")
    def windows(texts: pa.Array) -> pa.Array:
        rows = []
        for raw in utf8(texts):
            words = words_of(raw)
            step = min(size, len(words))
            grams = {b" ".join(words[i : i + step]) for i in range(len(words) - step + 1)} if words else ()
            rows.append([g.decode() for g in sorted(grams)])
        return pa.array(rows, pa.list_(pa.string()))

    return windows


def benchmark_windows(benchmark: DataFrame, size: int = 10, text: str = "text", key: str = "item_id") -> DataFrame:
    """Distinct windows of the items: ``gram``, the sorted ``items`` that hold it, and ``piece_hash``.

    An item of fewer than ``size`` words is one window; an item without words has none.
    """
    show_code(benchmark)
    grams = benchmark.select(
        column(key).cast("string").alias("item"), F.explode(_windows_udf(size)(column(text))).alias("gram")
    )
    return grams.groupBy("gram").agg(
        F.sort_array(F.collect_set("item")).alias("items"), F.first(F.xxhash64("gram")).alias("piece_hash")
    )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    into: str = "leaks",
    size: int = 10,
    text: str = "text",
    item_text: str = "text",
    item_key: str = "item_id",
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """``docs`` with a struct ``into``: n_words, n_hit, items, hits.

    A word inside any occurrence of a benchmark window is hit. ``items`` are the ids, as
    text, of the items with an occurring window; items without id count as hits but have
    no entry. ``hits`` are merged runs: words ``first`` up to ``last``, bytes ``start`` up
    to ``stop`` of the UTF-8 text. A null text has no words. An empty benchmark finds
    nothing. A column called ``into`` is replaced.

    Beyond ``max_windows`` the benchmark is cut into pieces, each scanned for by a pass of its
    own whose result is written, so the driver and a worker hold one piece at a time.
    """
    show_code(docs)
    windows = materialize(benchmark_windows(benchmark, size, item_text, item_key), "windows")
    pieces = max(1, -(-windows.count() // max_windows))
    spark = docs.sparkSession
    rows = docs.withColumn(into, F.lit(None).cast(LEAKS))
    for piece in range(pieces):
        part = windows.filter(F.pmod("piece_hash", F.lit(pieces)) == piece).select("gram", "items")
        held = spark.sparkContext.broadcast(WindowSet([(r.gram, list(r["items"])) for r in part.collect()]))
        rows = rows.withColumn(into, _scanner(held)(column(text), column(into)))
        if piece < pieces - 1:
            rows = materialize(rows, "scanned")
            held.unpersist()
    return rows


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with their own columns."""
    into = fresh(docs, "leaks")
    found = find_leaks(docs, benchmark, into, text=text, **options)
    return found.filter(column(into)["n_hit"] == 0).select(*[column(c) for c in docs.columns])


def _cut(texts: pa.Array, leaks: pa.Array) -> pa.Array:
    rows = []
    for raw, found in zip(texts.cast(pa.large_binary()).to_pylist(), leaks.to_pylist()):
        for hit in reversed(found["hits"]):
            raw = raw[: hit["start"]] + raw[hit["stop"] :]
        rows.append(None if raw is None else raw.decode())
    return pa.array(rows, pa.string())


def cut_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the hit words cut out of their texts; null stays null."""
    into = fresh(docs, "leaks")
    found = find_leaks(docs, benchmark, into, text=text, **options)
    return found.withColumn(text, arrow_udf(_cut, "string")(column(text), column(into))).select(*[column(c) for c in docs.columns])
