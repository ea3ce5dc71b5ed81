"""Personal data: sure finds by their form, further ones by contexts learned from those.

One scan of the texts finds the sure entities (the seeds) and candidates, which look like
identifiers and match no form, each with the words beside it. Bootstrapping then runs in
Spark on a graph of lexical patterns (those words) and instances (identifiers without their
punctuation). A pattern's confidence in a kind is what its instances score for that kind, over
all its distinct instances; confident patterns raise the scores of the unseen instances they
hold, which count in the next round. In the end candidates whose instance is taken for a kind
become spans of it. An instance counts once per pattern, so copies of a document add nothing.
Only identifiers and their contexts are shuffled, never texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from gradewise.functions import column
from gradewise.llm.text import fresh, hash_pair, show_code
from gradewise.sources.scratch import materialize

# Kinds in the order of their spans, and the forms of sure entities. Possessive
# quantifiers and the check before an ip keep the time in proportion to the text.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (13, 19), (9, 15)

# What may be an identifier: runs of digits with a little punctuation, names at hosts.
NUMBER = re.compile(r"[0-9](?:[\x20()./-]{0,2}[0-9])++")
LEAST_DIGITS = 7
WRITTEN_AT = re.compile(r"[\[({]\x20?at\x20?[\])}]|@", re.IGNORECASE)
WRITTEN_DOT = re.compile(r"\x20?[\[({]\x20?dot\x20?[\])}]\x20?", re.IGNORECASE)
WRITTEN_HOST = re.compile(
    r"\x20?[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[({]\x20?dot\x20?[\])}]\x20?)[A-Za-z0-9-]{1,63}){0,8}", re.IGNORECASE
)

#: Characters on either side that the words of a context are taken from.
CONTEXT = 48
#: Characters that a name before an "at" has at most.
NAME = 64
NOT_A_DIGIT = re.compile(r"[^0-9]+")

MET = "array<struct<kind: string, shape: string, start: bigint, end: bigint, instance: string, patterns: array<string>>>"
MET_ARROW = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()),
            ("shape", pa.string()),
            ("start", pa.int64()),
            ("end", pa.int64()),
            ("instance", pa.string()),
            ("patterns", pa.list_(pa.string())),
        ]
    )
)


def passes_luhn(digits: str) -> bool:
    """Every second digit from the right doubled, less 9 if over 9; the sum is a multiple of 10."""
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(int(d) for d in digits[::-2]) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Spans of name, @ and host. Names are found backwards from the @, which takes linear time."""
    found, low, at = [], 0, text.find("@")
    while at >= 0:
        host = HOST.match(text, at)
        start = low + len(text[low:at].rstrip(LOCAL)) if host else at
        low = at + 1
        if start < at:
            low = host.end()
            found.append((start, low))
        at = text.find("@", low)
    return found


def _is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _is_card(text: str) -> bool:
    digits = NOT_A_DIGIT.sub("", text)
    return CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and passes_luhn(digits)


def _is_phone(text: str) -> bool:
    return PHONE_DIGITS[0] <= len(NOT_A_DIGIT.sub("", text)) <= PHONE_DIGITS[1]


def sure_entities(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of all sure entities, by kind and then by start."""
    found = [("email", *span) for span in emails(text)]
    for kind, form, holds in (("ip", IP, _is_ip), ("card", CARD, _is_card), ("phone", PHONE, _is_phone)):
        found += [(kind, *m.span()) for m in form.finditer(text) if holds(m[0])]
    return found


def candidates(text: str, taken: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """Shape, start and end of what may be an identifier and overlaps neither ``taken`` nor another one."""
    found = []
    for m in WRITTEN_AT.finditer(text):
        before = text[max(0, m.start() - NAME) : m.start()]
        before = before[:-1] if before.endswith(" ") and m[0] != "@" else before
        name = len(before) - len(before.rstrip(LOCAL))
        host = WRITTEN_HOST.match(text, m.end())
        if name and host and (m[0] != "@" or host[0][0] != " "):
            start = max(0, m.start() - NAME) + len(before) - name
            found.append(("at", start, host.end()))
    for m in NUMBER.finditer(text):
        if m.end() - m.start() >= LEAST_DIGITS and len(NOT_A_DIGIT.sub("", m[0])) >= LEAST_DIGITS:
            start = m.start()
            start -= start > 0 and (text[start - 1] == "+" or text[start - 1] == "(" and ")" in m[0])
            found.append(("number", start, m.end()))
    free, busy = [], sorted(taken)
    ends, place = 0, 0  # both are walked in order of their starts
    for shape, start, end in sorted(found, key=lambda c: (c[1], -c[2])):
        while place < len(busy) and busy[place][0] < end:
            ends, place = max(ends, busy[place][1]), place + 1
        if start >= ends:
            free.append((shape, start, end))
            ends = end
    return free


def instance_of(kind: str | None, shape: str, text: str) -> str:
    """An identifier whatever its punctuation: digits of a number, lower-case letters of a name at a host."""
    if shape == "at":
        plain = WRITTEN_DOT.sub(".", WRITTEN_AT.sub("@", text)).replace(" ", "").lower()
    else:
        plain = text if kind == "ip" else NOT_A_DIGIT.sub("", text)
    return plain if len(plain) <= 64 else sha256(plain.encode()).hexdigest()


def patterns_of(shape: str, text: str, start: int, end: int) -> list[str]:
    """The word before, the two words before, and the words on both sides; digits count alike."""
    left = _plain(text[max(0, start - CONTEXT) : start]).split()[-2:]
    right = _plain(text[end : end + CONTEXT]).split()[:1]
    if not left:
        return []
    words = [[left[-1], "*"], [*left, "*"], [left[-1], "*", *right]]
    return [f"{shape}: {' '.join(w)}" for w in words[: 1 if len(left) == 1 else 2] + words[2:] * len(right)]


def _plain(text: str) -> str:
    return re.sub("[0-9]+", "0", text.lower())


def entities(text: str) -> list[tuple]:
    """Sure entities, then candidates (kind None), with shape, span, instance and patterns."""
    sure = sure_entities(text)
    free = candidates(text, [span for _, *span in sure])
    met = [(k, "at" if k == "email" else "number", a, b) for k, a, b in sure] + [(None, *c) for c in free]
    return [(k, s, a, b, instance_of(k, s, text[a:b]), patterns_of(s, text, a, b)) for k, s, a, b in met]


def _scan(texts: pa.Array) -> pa.Array:
    return pa.array([entities(t or "") for t in texts.to_pylist()], MET_ARROW)


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Written table ``row, key, t0, t1, met``: a row's number, key, text hashes, entities and candidates."""
    show_code(docs)
    found = arrow_udf(_scan, MET).asNondeterministic()
    t0, t1 = hash_pair(F.coalesce(column(text), F.lit("")))
    return materialize(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            column(key).alias("key"),
            t0.alias("t0"),
            t1.alias("t1"),
            found(column(text)).alias("met"),
        ),
        "entities",
    )


def bootstrap(
    met: DataFrame, rounds: int = 3, min_support: float = 5, min_confidence: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """Instances ``instance, kind, score`` and the patterns ``pattern, kind, support, confidence`` that found them.

    ``met`` has the columns ``kind, instance, patterns`` of entities and candidates, kind
    null for the latter. Seeds score 1 for each of their kinds. A round takes the patterns
    whose instances score ``min_support`` in sum for a kind and ``min_confidence`` on average,
    all instances counted. Any other instance they hold scores 1 less the product of their
    doubts, and takes the kind it scores most for, the first in ``KINDS`` if several.
    """
    edges = materialize(
        met.select("instance", F.explode("patterns").alias("pattern")).distinct(), "pattern-instances"
    )
    sizes = materialize(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), "pattern-sizes")
    seeds = materialize(
        met.filter(F.col("kind").isNotNull()).select("instance", "kind").distinct().withColumn("score", F.lit(1.0)),
        "seeds",
    )
    known = seeds.select("instance").distinct()
    scores, patterns = seeds, None
    preferred = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    for _ in range(rounds):
        supported = (
            edges.join(scores, "instance")
            .groupBy("pattern", "kind")
            .agg(F.sum("score").alias("support"))
            .filter(F.col("support") >= min_support)
        )
        confidence = F.col("support") / F.col("n")
        patterns = materialize(
            supported.join(sizes, "pattern")
            .select("pattern", "kind", "support", confidence.alias("confidence"))
            .filter(F.col("confidence") >= min_confidence),
            "patterns",
        )
        doubt = F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))
        held = (
            edges.join(patterns, "pattern")
            .groupBy("instance", "kind")
            .agg((1 - F.exp(F.sum(doubt))).alias("score"))
            .groupBy("instance")
            .agg(F.max(F.struct("score", (-preferred).alias("first"), "kind")).alias("best"))
            .join(known, "instance", "left_anti")
            .select("instance", "best.kind", "best.score")
        )
        scores = materialize(seeds.unionByName(held), "instances")
    return scores, patterns


def personal_data(
    docs: DataFrame, text: str = "text", key: str = "doc_id", rounds: int = 3, **limits
) -> DataFrame:
    """``key, t0, t1, base, added``: a row per row of ``docs``, with two arrays of ``kind, start, end``.

    ``base`` has the sure entities by kind and start, ``added`` what bootstrapping found; such
    spans overlap no sure entity. Offsets count code points, ends are exclusive. ``t0, t1``
    are hashes of the text, null as empty; null and empty texts have no spans. Rows that
    repeat a key or a text have rows and spans of their own. An instance is taken for a kind
    everywhere or nowhere; if it is sure of several kinds, its candidates take the first of
    ``KINDS``. Other columns play no part; an empty table gives an empty one.
    """
    scanned = scan(docs, text, key)
    met = scanned.select("row", F.explode("met").alias("m")).select("row", "m.*")
    scores, _ = bootstrap(met, rounds, **limits)
    preferred = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    kinds = scores.groupBy("instance").agg(F.min(F.struct(preferred, F.col("kind").alias("kind"))).alias("k"))
    found = (
        met.filter(F.col("kind").isNull())
        .select("row", "start", "end", "instance")
        .join(materialize(kinds.select("instance", "k.kind"), "taken"), "instance")
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    )
    none = F.array().cast("array<struct<kind: string, start: bigint, end: bigint>>")
    base = F.transform(
        F.filter("met", lambda m: m["kind"].isNotNull()), lambda m: F.struct(m["kind"], m["start"], m["end"])
    )
    return scanned.join(found, "row", "left").select(
        F.col("key").alias(key), "t0", "t1", base.alias("base"), F.coalesce("added", none).alias("added")
    )


def in_order(spans):
    """Spans by kind as in ``KINDS``, then by start."""
    place = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(
        spans, lambda s: F.struct(F.array_position(place, s["kind"]), s["start"], s["end"], s["kind"].alias("kind"))
    )
    return F.transform(F.sort_array(keyed), lambda s: F.struct(s["kind"], s["start"], s["end"]))


def _masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
    return pa.array([mask(t or "", s or []) for t, s in zip(texts.to_pylist(), spans.to_pylist())], pa.string())


def mask(text: str, spans: list[dict]) -> str:
    """The text with each span replaced by its kind in brackets; of spans that overlap, the first one's."""
    pieces, at = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if span["start"] >= at:
            pieces += [text[at : span["start"]], f"[{span['kind'].upper()}]"]
        at = max(at, span["end"])
    return "".join([*pieces, text[at:]])


def mask_personal_data(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``docs`` with all found personal data in ``text`` replaced by its kind; a null text becomes empty."""
    own = {name: fresh(docs, name) for name in ("h0", "h1", "found_key", "found_t0", "found_t1", "found_spans")}
    found = personal_data(docs, text, key, **options)
    # Rows alike in key and text have the same spans.
    spans = found.select(
        column(key).alias(own["found_key"]),
        F.col("t0").alias(own["found_t0"]),
        F.col("t1").alias(own["found_t1"]),
        F.concat("base", "added").alias(own["found_spans"]),
    ).dropDuplicates([own["found_key"], own["found_t0"], own["found_t1"]])
    h0, h1 = hash_pair(F.coalesce(column(text), F.lit("")))
    rows = docs.select("*", h0.alias(own["h0"]), h1.alias(own["h1"]))
    same = (
        (F.col(own["found_t0"]) == F.col(own["h0"]))
        & (F.col(own["found_t1"]) == F.col(own["h1"]))
        & column(key).eqNullSafe(F.col(own["found_key"]))
    )
    show_code(docs)
    masked = arrow_udf(_masked, "string").asNondeterministic()(column(text), F.col(own["found_spans"]))
    return rows.join(spans, same).select(*[masked.alias(c) if c == text else column(c) for c in docs.columns])
