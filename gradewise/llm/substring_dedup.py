"""Repeated passages, dropped by content-defined chunks.

A gear hash rolls over the bytes of a text: each step shifts it left and adds a random
number of the byte, over the last 8 bytes. Of every 9 words in a row the one with the
least hash ends a chunk, so chunks have about five words and never over 9. Ends depend on
the content near them, and after an insertion the chunks are soon the same again.

Where words are long, or their script has no spaces between words, every character counts as
part of a word, one byte as a sixth, and a chunk may end after it: of any 54 bytes in a row
the least hash ends one. Words and such characters are the units that texts are cut into.

A chunk may be of one word, which tells nothing. So from every chunk on, neighbours are
joined to it until they have ``min_words`` words, and this run of whole chunks, of variable
length, gets a digest of 128 bits; the text's last chunks make one more run. A digest in two
or more documents belongs to the one with the smallest key; the others drop the run's
chunks. Runs overlap, so a longer repeat goes as a whole but for the chunks at its ends
that its surroundings cut otherwise. Only digests and places move, then places back to texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from gradewise.functions import column
from gradewise.llm.text import SPACES, show_code, utf8
from gradewise.sources.scratch import materialize

GEAR = np.random.default_rng(20240613).integers(0, 1 << 32, 256, dtype=np.uint32)
#: Doubling steps; the hash covers 2 ** STEPS bytes.
STEPS = 3
#: One in so many word ends closes a chunk.
WORDS_PER_CHUNK = 5
#: Of so many word ends in a row the least hash closes one, which makes 2 in WINDOW + 1 of them.
WINDOW = 2 * WORDS_PER_CHUNK - 1
#: Bytes of unspaced text that weigh as much as a word; the weight of a word is this too.
WORD_BYTES = 6
#: Longer words, such as base64 or minified code, count by their bytes.
LONG_WORD = 32
#: A longer run of bytes without an end, of white space, is cut at every so many bytes.
MOST_BYTES = 4096

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES.encode())] = True


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte, by doubling the number of bytes it covers."""
    h = GEAR[raw]
    for step in range(STEPS):
        reach = 1 << step
        wider = h.copy()
        wider[reach:] += h[:-reach] << np.uint32(reach)
        h = wider
    return h


def least_in_windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least hash, the last of equal ones, of some ``width`` places in a row."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    low = hashes.astype(np.uint64) << np.uint64(32) | np.arange(len(hashes), 0, -1, dtype=np.uint64)
    reach = 1
    while reach < width:
        more = min(reach, width - reach)
        low = np.minimum(low[:-more], low[more:])
        reach += more
    low = low[np.append(True, low[1:] != low[:-1])]
    return np.unique(len(hashes) - (low & np.uint64(0xFFFFFFFF)).astype(np.int64))


def words_in(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and where they stop."""
    space = IS_SPACE[raw]
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))
    return starts, np.flatnonzero(~space & np.append(space[1:], True)) + 1


def unspaced(raw: np.ndarray) -> np.ndarray:
    """First bytes of characters whose script has no spaces: Thai, Lao, Burmese, Khmer, Chinese, Japanese."""
    lead = np.flatnonzero((raw >= 0xE0) & (raw <= 0xF0))
    if not len(lead):
        return lead
    a, b = raw[lead], raw[np.minimum(lead + 1, len(raw) - 1)]
    thai_lao = (a == 0xE0) & (b >= 0xB8) & (b <= 0xBB)
    burmese_khmer = (a == 0xE1) & ((b <= 0x82) | (b == 0x9E) | (b == 0x9F))
    return lead[thai_lao | burmese_khmer | (a >= 0xE3) & (a <= 0xE9) | (a == 0xF0) & (b >= 0xA0) & (b <= 0xB3)]


def units_in(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where units start and stop, and the weight of all up to each: words, or characters of unspaced text."""
    starts, stops = words_in(raw)
    split = stops - starts > LONG_WORD
    split[np.searchsorted(starts, unspaced(raw), side="right") - 1] = True
    if not split.any():
        return starts, stops, WORD_BYTES * np.arange(1, len(starts) + 1)
    inside = np.zeros(len(raw) + 1, np.int64)
    inside[starts[split]] += 1
    inside[stops[split]] -= 1
    first = (np.cumsum(inside[:-1]) > 0) & ((raw & 0xC0) != 0x80)
    first[starts] = True
    begins = np.flatnonzero(first)
    word = np.searchsorted(starts, begins, side="right") - 1
    ends = np.minimum(np.append(begins[1:], len(raw)), stops[word])
    return begins, ends, np.cumsum(np.where(split[word], ends - begins, WORD_BYTES))


def closing(raw: np.ndarray, stops: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Places among the units of those that end a chunk."""
    hashes = gear_hashes(raw)[stops - 1]
    if not len(stops) or weights[-1] == WORD_BYTES * len(stops) and (np.diff(weights, prepend=0) == WORD_BYTES).all():
        return least_in_windows(hashes, WINDOW)
    # A place for each byte of weight; only those at which units end can be the least.
    spread = np.full(weights[-1], np.iinfo(np.uint32).max, np.uint32)
    spread[weights - 1] = np.minimum(hashes, np.uint32(np.iinfo(np.uint32).max - 1))
    least = least_in_windows(spread, WINDOW * WORD_BYTES)
    return np.searchsorted(weights, least[spread[least] < np.iinfo(np.uint32).max] + 1)


def chunk_ends(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where chunks end, and how many words each has; a word belongs to the chunk it starts in."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = np.frombuffer(text, np.uint8)
    starts, _ = words_in(raw)
    _, stops, weights = units_in(raw)
    ends = stops[closing(raw, stops, weights)]
    ends = ends + (IS_SPACE[raw[np.minimum(ends, len(raw) - 1)]] & (ends < len(raw)))  # with the white space after a word
    if not len(ends) or ends[-1] != len(raw):
        ends = np.append(ends, len(raw))
    gaps = np.diff(ends, prepend=0)
    if gaps.max() > MOST_BYTES:
        more = []
        for at in np.flatnonzero(gaps > MOST_BYTES).tolist():
            cuts = np.arange(ends[at] - gaps[at] + MOST_BYTES, ends[at], MOST_BYTES)
            for back in range(3):  # no cut inside a character
                cuts = cuts - ((raw[cuts] & 0xC0) == 0x80)
            more.append(cuts)
        ends = np.union1d(ends, np.concatenate(more))
    return ends, np.diff(np.searchsorted(starts, ends), prepend=0)


def chunk_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where units start and stop, the weight before each and in all, and the units at which chunks begin.

    The number of units is the last bound.
    """
    starts, stops, weights = units_in(raw)
    bounds = np.unique(np.concatenate([[0], closing(raw, stops, weights) + 1, [len(stops)]]))
    return starts, stops, np.append(0, weights), bounds


def chunk_runs(before: np.ndarray, bounds: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The first unit and the one past the last of every run of chunks that has a digest.

    From each chunk the shortest run of at least ``min_words`` words, and the shortest at the text's end.
    """
    at, need = before[bounds], WORD_BYTES * min_words
    if at[-1] < need:
        return (np.zeros(0, np.int64),) * 2
    past = np.searchsorted(at, at + need)
    whole = past < len(at)
    last = np.searchsorted(at, at[-1] - need, side="right") - 1
    first, past = bounds[whole], bounds[past[whole]]
    if past[-1] != bounds[-1]:  # the chunk ``last`` is the last to start a run
        first, past = np.append(first, bounds[last]), np.append(past, bounds[-1])
    return first, past


def _digester(min_words: int):
    def digests_of(texts: pa.Array) -> pa.Array:
        """Per text: number and two halves of the digest of every run of chunks."""
        import xxhash

        digest = xxhash.xxh3_128_digest
        digests, places, offsets = [], [], [0]
        for text in utf8(texts):
            if not text:
                offsets.append(offsets[-1])
                continue
            starts, stops, before, bounds = chunk_bounds(np.frombuffer(text, np.uint8))
            first, past = chunk_runs(before, bounds, min_words)
            ends = stops[past - 1]
            digests += [digest(text[a:b]) for a, b in zip(starts[first].tolist(), ends.tolist())]
            places.append(np.arange(len(first)))
            offsets.append(offsets[-1] + len(first))
        halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        flat = np.concatenate(places) if places else np.zeros(0, np.int64)
        fields = [
            pa.array(flat.astype(np.int32)),
            pa.array(np.ascontiguousarray(halves[:, 0])),
            pa.array(np.ascontiguousarray(halves[:, 1])),
        ]
        return pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, ["place", "h0", "h1"])
        )

    return arrow_udf(digests_of, "array<struct<place:int,h0:bigint,h1:bigint>>")


def _cutter(min_words: int):
    result = pa.struct([("kept", pa.string()), ("n_chunks", pa.int64()), ("n_words", pa.int64())])

    def cut(texts: pa.Array, repeated: pa.Array) -> pa.Array:
        rows = []
        for text, places in zip(utf8(texts), repeated.to_pylist()):
            if not places:
                rows.append({"kept": text.decode(), "n_chunks": 0, "n_words": 0})
                continue
            starts, stops, before, bounds = chunk_bounds(np.frombuffer(text, np.uint8))
            first, past = chunk_runs(before, bounds, min_words)
            turns = np.zeros(len(starts) + 1, np.int64)
            np.add.at(turns, first[places], 1)
            np.add.at(turns, past[places], -1)
            gone = np.cumsum(turns[:-1]) > 0
            edges = np.flatnonzero(np.diff(gone, prepend=False, append=False))
            kept, at = [], 0
            for a, b in edges.reshape(-1, 2).tolist():  # units a to b - 1
                kept.append(text[at : starts[a] if a else 0])
                at = starts[b] if b < len(starts) else len(text)
                if a and starts[a] == stops[a - 1]:  # the white space after them parts what is left
                    at = stops[b - 1]
            kept.append(text[at:])
            n_chunks, weight = int(gone[bounds[:-1]].sum()), int(np.diff(before)[gone].sum())
            rows.append({"kept": b"".join(kept).decode(), "n_chunks": n_chunks, "n_words": -(-weight // WORD_BYTES)})
        return pa.array(rows, result)

    return arrow_udf(cut, "struct<kept:string,n_chunks:bigint,n_words:bigint>").asNondeterministic()


def repeated_chunks(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = 16) -> DataFrame:
    """``h0, h1, owner`` of the digests that at least two rows of ``docs`` hold."""
    found = _digester(min_words)(column(text))
    pairs = F.transform(found, lambda c: F.struct(c["h0"].alias("h0"), c["h1"].alias("h1")))
    return (
        docs.select(column(key).alias("id"), F.explode(F.array_distinct(pairs)).alias("c"))
        .groupBy("c.h0", "c.h1")
        .agg(F.min("id").alias("owner"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )


def drop_repeated_passages(
    docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = 16
) -> DataFrame:
    """One row per row of ``docs``: the key, ``n_dropped_chunks``, ``n_dropped_words``, ``kept_text``.

    Dropped are the chunks of every run that a document with a smaller key also has: ``min_words``
    words or more, from one chunk's start to another's end. Of 9 words in a row one ends a
    chunk and the hash covers up to 4 words, so a repeat of ``min_words`` + 29 words is certain
    to be found wherever it stands; at most 13 of its words stay at the start and 24 at the end. A passage stays in the document with the smallest key;
    whole copies of a text of ``min_words`` words lose all of it elsewhere.
    In unspaced text (long words, and scripts without spaces) six bytes count as a word, here
    and in ``n_dropped_words``. Repeats inside one document stay. Each row is a document; rows that repeat a key keep
    or lose a passage together. Null keys lose against others; among null keys alone a
    passage stays everywhere. A null text counts as empty. Other columns play no part.
    """
    show_code(docs)
    rows = docs.select(
        column(key).alias("id"),
        column(text).alias("text"),
        F.xxhash64(F.coalesce(column(text), F.lit(""))).alias("t"),
    )
    # Written, so that both sides of the join are dealt out for it and a hot digest can be split.
    repeated = materialize(repeated_chunks(docs, text, key, min_words), "repeated-chunks")
    gone = (
        rows.select("id", "t", F.explode(_digester(min_words)(F.col("text"))).alias("c"))
        .select("id", "t", "c.place", "c.h0", "c.h1")
        .join(repeated, ["h0", "h1"])
        .filter(~F.col("id").eqNullSafe(F.col("owner")))
        .groupBy(F.col("id").alias("gid"), F.col("t").alias("gt"))
        .agg(F.collect_set("place").alias("places"))
    )
    same = F.col("id").eqNullSafe(F.col("gid")) & (F.col("t") == F.col("gt"))
    joined = rows.join(gone, same, "left").select("id", _cutter(min_words)("text", "places").alias("c"))
    return joined.select(
        F.col("id").alias(key),
        F.col("c.n_chunks").alias("n_dropped_chunks"),
        F.col("c.n_words").alias("n_dropped_words"),
        F.col("c.kept").alias("kept_text"),
    )
