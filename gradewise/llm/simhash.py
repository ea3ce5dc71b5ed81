"""Near copies by 64-bit fingerprints at most three bits apart, found by pigeonring filtering.

A fingerprint is a ring of four 16-bit segments. If two fingerprints differ in at most
three bits, then from some segment on, clockwise, the differences of the first one, two,
three and four segments stay within 0, 1, 2 and 3 (each chain's share of the budget).
So some segment is equal, the next differs in at most one bit, and the two after it in
at most two in all. This makes exact join keys of 29 or 30 bits: the equal segment, an
equal half of the next one, and an equal part (of three) of the one after, 24 keys per
fingerprint. Candidates pass the chain's budgets before the whole is compared.

Only distinct fingerprints are joined: copies of a text, however many, are one row there.
Keys that many distinct fingerprints share are joined pair by pair no longer. Their
fingerprints meet at common points instead: each lists the points within one bit and
those within two, and two lists cross if and only if the fingerprints link. That is a
fixed number of rows per fingerprint, whatever the group's size, so every link still counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from gradewise.functions import column
from gradewise.llm.text import fresh, show_code, utf8
from gradewise.sources.scratch import materialize

MOST_BITS = 3
SEGMENT = 0xFFFF
# Bounds of the halves of a segment and of its three parts: first bit, number of bits.
HALVES = ((0, 8), (8, 8))
PARTS = ((0, 5), (5, 5), (10, 6))
#: Shingles whose bits are counted at once.
COUNTED = 200_000


def fingerprint_of(text: bytes, width: int = 3, seed: int = 42) -> int:
    """The 64 bits set in over half the hashes of the text's word shingles."""
    import xxhash

    words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    starts = stops - lengths
    width = min(width, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), stops[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(first), COUNTED):
        pairs = zip(first[at : at + COUNTED], last[at : at + COUNTED])
        hashes = np.array([digest(joined[a:b], seed) for a, b in pairs], np.dtype("<u8"))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(first), bitorder="little").view("<u8")[0])


def _fingerprints(texts: pa.Array) -> pa.Array:
    values = np.array([fingerprint_of(t) for t in utf8(texts)], np.uint64)
    return pa.array(values.view(np.int64))


def fingerprint(text: Column) -> Column:
    """The fingerprint as a signed 64-bit number; of a null or wordless text it is zero."""
    return arrow_udf(_fingerprints, "bigint").asNondeterministic()(text)


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _segment(fp: Column, place: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * (place % 4)).bitwiseAND(F.lit(SEGMENT))


def _bits(value: Column, first: int, n: int) -> Column:
    return F.shiftright(value, first).bitwiseAND(F.lit((1 << n) - 1))


def ring_keys(fp: Column) -> Column:
    """Array of the 24 join keys. From bit 40 on they hold their kind: the start and the equal parts."""
    keys = []
    for start in range(4):
        whole, after, third = (_segment(fp, start + i) for i in range(3))
        for half, (first, n) in enumerate(HALVES):
            for part, (at, size) in enumerate(PARTS):
                kind = (start * len(HALVES) + half) * len(PARTS) + part
                bits = F.shiftleft(whole, 16)
                bits = bits.bitwiseOR(F.shiftleft(_bits(after, first, n), 8))
                keys.append(bits.bitwiseOR(_bits(third, at, size)).bitwiseOR(F.lit(kind << 40)))
    return F.array(*keys)


def within_budgets(a: Column, b: Column, kind: Column) -> Column:
    """The chain from the kind's start keeps to 0, 1, 2, 3 differing bits."""
    start = F.floor(kind / (len(HALVES) * len(PARTS))).cast("int")
    apart = a.bitwiseXOR(b)
    ok = F.lit(False)
    for s in range(4):
        chain = [F.bit_count(_segment(apart, s + i)) for i in range(4)]
        good = (chain[0] == 0) & (chain[1] <= 1) & (chain[1] + chain[2] <= 2)
        ok = F.when(start == s, good & (chain[1] + chain[2] + chain[3] <= MOST_BITS)).otherwise(ok)
    return ok


def _flips(bits: int) -> list[int]:
    """Signed masks of at most ``bits`` of 64 bits."""
    one = [1 << i for i in range(64)]
    masks = [0, *one] + ([a | b for i, a in enumerate(one) for b in one[:i]] if bits > 1 else [])
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, crowd: int = 2_000) -> DataFrame:
    """Pairs ``a < b`` of fingerprints at most three bits apart that connect all that link.

    ``fps`` has distinct values ``fp``. Every link is listed, but for those that only keys
    of over ``crowd`` fingerprints show: these take the way by common points, which lists
    enough of them to connect the same fingerprints.
    """
    keyed = fps.select("fp", F.explode(ring_keys(F.col("fp"))).alias("key"))
    counts = keyed.groupBy("key").count()
    crowded = materialize(counts.filter(F.col("count") > crowd).select("key"), "crowded-keys")
    few = keyed
    if not crowded.isEmpty():
        few = keyed.join(crowded, "key", "left_anti")
    left, right = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    kind = F.shiftright("key", 40)
    near = (
        left.join(right.hint("merge"), "key")  # Spark does not see that a row becomes 24
        .filter((F.col("a") < F.col("b")) & within_budgets(F.col("a"), F.col("b"), kind))
        .filter(distance(F.col("a"), F.col("b")) <= MOST_BITS)
        .select("a", "b")
    )
    if crowded.isEmpty():
        return near.distinct()
    many = keyed.join(crowded, "key", "left_semi").select("fp").distinct()
    return near.union(_links_by_points(many)).distinct()


def _links_by_points(fps: DataFrame) -> DataFrame:
    """Edges that connect what links, by points: one bit from one end, two from the other.

    A point joins the fingerprints around it to the smallest one within a bit of it. That
    one and a fingerprint within two bits of the point link, so no edge is false, and
    whoever links to another within a bit of the point is connected through it.
    """
    inner = F.array(*[F.lit(m) for m in _flips(1)])
    outer = F.array(*[F.lit(m) for m in _flips(2)])
    point = F.col("fp").bitwiseXOR(F.col("mask")).alias("point")
    near = fps.select("fp", F.explode(inner).alias("mask")).select(point, "fp")
    far = fps.select("fp", F.explode(outer).alias("mask")).select(point, "fp")
    anchors = near.groupBy("point").agg(F.min("fp").alias("anchor"))
    pairs = far.join(anchors.hint("merge"), "point").select("anchor", "fp").filter(F.col("anchor") != F.col("fp"))
    return pairs.select(F.least("anchor", "fp").alias("a"), F.greatest("anchor", "fp").alias("b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root``: the smallest node that edges lead to. By alternating star rounds.

    Each round every node joins its neighbours to the smallest among them, first those
    larger than itself and then the smaller ones. Tables of edges are written between
    rounds; nothing but a count comes to the driver.
    """
    edges = materialize(edges.select(F.col(a).alias("u"), F.col(b).alias("v")), "edges")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        edges = materialize(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: the key, the signed ``fp`` and ``component_id``.

    Fingerprints link at three or fewer differing bits; ``component_id`` is the smallest
    key that links lead to, the document itself included. Texts without words have the
    fingerprint zero and link like any other. Null keys are passed over for
    ``component_id``, which is null only if all keys of a component are. Rows that repeat
    a key are documents of their own. Other columns play no part.
    """
    show_code(docs)
    rows = materialize(docs.select(column(key).alias("id"), fingerprint(column(text)).alias("fp")), "fingerprints")
    owners = materialize(rows.groupBy("fp").agg(F.min("id").alias("top")), "owners")
    member = components(links(owners.select("fp")))
    rooted = owners.join(member, F.col("fp") == F.col("node"), "left").select(
        "fp", "top", F.coalesce("root", "fp").alias("root")
    )
    # Written, so that the join's sides are dealt out for it alone and a large component can be split.
    smallest = materialize(rooted.groupBy("root").agg(F.min("top").alias("component_id")), "components")
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col("id").alias(key), "fp", "component_id")


# Groups by similarity ------------------------------------------------------------------
#
# Edits of a few words in a hundred move 64-bit fingerprints by up to a dozen bits, which
# no three-bit link shows. Where documents of a given shingle similarity are asked for,
# minima of hashed shingles propose pairs beside the fingerprints, and every proposed pair
# is compared shingle by shingle.

BANDS, ROWS = 32, 4
SHINGLE = 5


def shingle_hashes(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the text's word shingles, sorted; of fewer words, of all of them."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    width = min(width, len(words))
    first = (stops - lengths)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b]) for a, b in zip(first, stops[width - 1 :].tolist())], np.uint64))


def _factors() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240611)
    return rng.integers(0, 1 << 63, (2, BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(shingles: np.ndarray, factors) -> list[int]:
    """Per band a hash of its rows' least hashed shingles; none for a text without words."""
    if not len(shingles):
        return []
    times, plus = factors
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 20_000):
        mixed = shingles[at : at + 20_000] * times + plus
        mixed ^= mixed >> np.uint64(32)
        least = np.minimum(least, (mixed * times).min(axis=1))
    keys = np.zeros(BANDS, np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ row) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64).tolist()


def _signatures(texts: pa.Array) -> pa.Array:
    import xxhash

    factors, rows = _factors(), []
    for text in utf8(texts):
        words = b" ".join(text.lower().split())
        digest = xxhash.xxh3_128_hexdigest(words)
        fp = fingerprint_of(text)
        rows.append({"node": digest, "fp": fp - (1 << 64) if fp >> 63 else fp, "bands": band_keys(shingle_hashes(text), factors)})
    return pa.array(rows, pa.struct([("node", pa.string()), ("fp", pa.int64()), ("bands", pa.list_(pa.int64()))]))


def _nodes(texts: pa.Array) -> pa.Array:
    import xxhash

    return pa.array([xxhash.xxh3_128_hexdigest(b" ".join(t.lower().split())) for t in utf8(texts)], pa.string())


def _similarities(left: pa.Array, right: pa.Array) -> pa.Array:
    # Neighbouring pairs have texts in common, so a batch shingles each of its texts once.
    known, out = {}, []
    for a, b in zip(utf8(left), utf8(right)):
        for text in (a, b):
            if text not in known:
                known[text] = shingle_hashes(text)
        x, y = known[a], known[b]
        both = len(np.intersect1d(x, y, assume_unique=True))
        out.append(both / max(len(x) + len(y) - both, 1))
    return pa.array(out, pa.float64())


def meetings(nodes: DataFrame) -> DataFrame:
    """``node``, ``meet``: the bands, fingerprints and links of fingerprints that a node shares with another."""
    linked = materialize(links(nodes.select("fp").distinct()), "linked-prints")
    bands = nodes.select("node", F.posexplode("bands").alias("band", "value")).select(
        "node", F.xxhash64("band", "value").alias("meet")
    )
    same = nodes.select("node", F.xxhash64(F.lit("fp"), "fp").alias("meet"))
    ends = linked.select(F.explode(F.array("a", "b")).alias("fp"), F.xxhash64(F.lit("link"), "a", "b").alias("meet"))
    met = bands.union(same).union(ends.join(nodes.select("fp", "node"), "fp").select("node", "meet"))
    # Written, here and below, so that a key of very many rows can be split in the join.
    shared = materialize(met.groupBy("meet").count().filter("count > 1").select("meet"), "shared-keys")
    return met.join(shared, "meet", "left_semi").select("node", "meet")


def _unsettled(met: DataFrame, member: DataFrame) -> DataFrame:
    """``met`` with the nodes' ``root``, of those keys whose nodes are not all of one group yet."""
    rooted = met.join(member, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rooted.groupBy("meet").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
    return rooted.join(materialize(several.select("meet"), "open-keys"), "meet", "left_semi")


def _star_pairs(met: DataFrame) -> DataFrame:
    """Each node with the smallest and the largest one of its key: no more than two pairs per row."""
    ends = met.groupBy("meet").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    held = met.join(materialize(ends, "ends"), "meet")
    pairs = [held.select(F.least("node", end).alias("a"), F.greatest("node", end).alias("b")) for end in ("low", "high")]
    return pairs[0].union(pairs[1]).filter("a != b").distinct()


def _shingles(texts: pa.Array) -> pa.Array:
    return pa.array([shingle_hashes(t).view(np.int64) for t in utf8(texts)], pa.list_(pa.int64()))


def _prefixes(texts: DataFrame, similarity: float) -> DataFrame:
    """``node``, ``n``, ``meet``, ``place``: each text's rarest shingles, of which alike texts share one.

    Of n shingles that is n less ``similarity`` * n, and one more. Those that no other text
    has come first and are met by nobody, so a text with that many has no row. ``place``
    counts from 1 in the order of all the text's shingles.
    """
    hashes = arrow_udf(_shingles, "array<bigint>").asNondeterministic()("text")
    own = texts.select("node", hashes.alias("own"))
    held = materialize(own.select("node", F.size("own").alias("n"), F.explode("own").alias("meet")), "shingles")
    often = materialize(held.groupBy("meet").count().filter("count > 1"), "shared-shingles")
    alone = F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("node"))
    longest = F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1
    rank = F.row_number().over(Window.partitionBy("node").orderBy("count", "meet"))
    placed = held.join(often, "meet").withColumn("place", alone + rank)
    return placed.filter(F.col("place") <= longest).select("node", "n", "meet", "place")


def _rest_pairs(met: DataFrame, similarity: float) -> DataFrame:
    """Pairs of a shingle's texts that are not of one group: those outside its largest group with all others.

    At the first shingle that two texts share, what either has from there on bounds what
    they share in all. Pairs whose bound is too low for ``similarity`` are left out.
    """
    sizes = met.groupBy("meet", "root").count()
    largest = sizes.groupBy("meet").agg(F.max(F.struct("count", "root"))["root"].alias("largest"))
    outside = (F.col("root") != F.col("largest")).alias("outside")
    sided = met.join(materialize(largest, "largest-groups"), "meet").select(*met.columns, outside)
    sided = materialize(sided, "sides")
    x, y = sided.filter("outside").alias("x"), sided.alias("y")
    once = ~F.col("y.outside") | (F.col("x.node") < F.col("y.node"))
    apart = (F.col("x.meet") == F.col("y.meet")) & (F.col("x.root") != F.col("y.root")) & once
    most = 1 + F.least(*[F.col(f"{side}.n") - F.col(f"{side}.place") for side in "xy"])
    least = similarity / (1 + similarity) * (F.col("x.n") + F.col("y.n")) - 1e-9
    return x.join(y.hint("merge"), apart & (most >= least)).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
    ).distinct()


def _alike(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose texts have at least this similarity."""
    compare = arrow_udf(_similarities, "double").asNondeterministic()
    return (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
        .select("a", "b", compare("x", "y").alias("similarity"))
        .filter(F.col("similarity") >= similarity)
        .select("a", "b")
    )


def similar_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: the key and ``component_id``, the smallest key of its group.

    Documents are linked if their sets of five-word shingles (A-Z in lower case, white space
    between words of no account) have a Jaccard similarity of at least ``similarity``, among
    the pairs that fingerprints at most three bits apart or a band of minima propose. At 0.8
    a pair shares no band once in 20 million times, and is lost only if nothing else connects it. Groups are what links connect. Every node of a
    key is compared with two of them. Keys whose nodes are not of one group by then have all
    their nodes joined by their rarest shingles, which shows every link that is left, so no
    link that is proposed is lost, and a large group of alike texts takes few pairs.
    Texts without words are alike. Null keys are passed over; other columns play no part.
    """
    show_code(docs)
    signed = arrow_udf(_signatures, "struct<node:string,fp:bigint,bands:array<bigint>>").asNondeterministic()
    rows = docs.select(column(key).alias("id"), signed(column(text)).alias("s")).select("id", "s.*")
    rows = materialize(rows, "signatures")
    nodes = materialize(rows.select("node", "fp", "bands").dropDuplicates(["node"]), "nodes")
    met = materialize(meetings(nodes), "meetings")
    digest = arrow_udf(_nodes, "string").asNondeterministic()
    texts = docs.select(column(text).alias("text"))
    texts = texts.withColumn("node", digest("text")).join(met.select("node").distinct(), "node", "left_semi")
    texts = materialize(texts.groupBy("node").agg(F.min("text").alias("text")), "asked-texts")
    member = components(_alike(_star_pairs(met), texts, similarity))
    rest = materialize(_unsettled(met, member).select("node").distinct(), "unsettled")
    if not rest.isEmpty():
        prefixes = materialize(_prefixes(texts.join(rest, "node", "left_semi"), similarity), "prefixes")
        pairs = _rest_pairs(materialize(_unsettled(prefixes, member), "unsettled-prefixes"), similarity)
        member = components(_alike(pairs, texts, similarity).union(member))
    named = rows.select("id", "node").join(member.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left")
    named = named.select("id", F.coalesce("root", "node").alias("root"))
    smallest = materialize(named.groupBy("root").agg(F.min("id").alias("component_id")), "groups")
    return named.join(smallest, "root").select(F.col("id").alias(key), "component_id")


def keep_one_per_group(
    docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float | None = None
) -> DataFrame:
    """The rows of ``docs`` whose key is their group's smallest, with their own columns.

    Groups are those of ``near_copies``, or with a ``similarity`` those of ``similar_groups``.
    Of rows that repeat that key all stay if their texts are equal. A group whose keys are
    all null stays whole.
    """
    groups = near_copies(docs, text, key) if similarity is None else similar_groups(docs, text, key, similarity)
    name = fresh(docs, "component_id")
    kept = (
        groups.filter(column(key).eqNullSafe(F.col("component_id")))
        .select(column(key).alias(name))
        .distinct()
    )
    return docs.join(kept, column(key).eqNullSafe(column(name)), "left_semi")
