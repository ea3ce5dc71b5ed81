import hashlib
import math
import re
import time
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gradewise.llm import pii, queries
from gradewise.llm.pii import KINDS, bootstrap, candidates, emails, entities, mask, mask_personal_data, passes_luhn
from gradewise.llm.pii import personal_data, scan, sure_entities
from helpers import TRICKY, documents

# The forms as they are stated, without the module's care for long runs.
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for place, d in enumerate(reversed(digits)):
        d = int(d) * (1 + place % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return {
        "email": True,
        "ip": kind == "ip" and all(int(p) <= 255 for p in found.split(".")),
        "card": 13 <= len(digits) <= 19 and luhn(digits),
        "phone": 9 <= len(digits) <= 15,
    }[kind]


def plain_base(text):
    return [(k, *m.span()) for k in KINDS for m in re.finditer(FORMS[k], text or "") if holds(k, m[0])]


def plain_bootstrap(texts, rounds=3, support=5, confidence=0.8):
    """Kind of every taken instance, by loops over dictionaries."""
    edges, seeds = defaultdict(set), defaultdict(set)
    for text in texts:
        for kind, _, _, _, instance, patterns in entities(text or ""):
            for p in patterns:
                edges[p].add(instance)
            if kind:
                seeds[instance].add(kind)
    scores = {(i, k): 1.0 for i, kinds in seeds.items() for k in kinds}
    for _ in range(rounds):
        good = {}
        for p, instances in edges.items():
            for k in KINDS:
                total = sum(scores.get((i, k), 0) for i in instances)
                if total >= support - 1e-9 and total / len(instances) >= confidence - 1e-9:
                    good[p, k] = total / len(instances)
        doubts = defaultdict(float)
        for (p, k), c in good.items():
            for i in edges[p]:
                doubts[i, k] += math.log(max(1 - c, 1e-6))
        best = {}
        for (i, k), d in doubts.items():
            if i not in seeds:
                best[i] = max(best.get(i, (-1, 0, "")), (1 - math.exp(d), -KINDS.index(k), k))
        scores = {(i, k): 1.0 for i, kinds in seeds.items() for k in kinds} | {(i, b[2]): b[0] for i, b in best.items()}
    taken = {}
    for i, k in scores:
        taken[i] = min(taken.get(i, "~"), k, key=lambda x: KINDS.index(x) if x in KINDS else 9)
    return taken


def plain_spans(rows):
    taken = plain_bootstrap([r[1] for r in rows])
    for key, text, *_ in rows:
        met = entities(text or "")
        added = [(taken[i], a, b) for k, _, a, b, i, _ in met if k is None and i in taken]
        yield key, plain_base(text), sorted(added)


def found_spans(df):
    return sorted(
        (str(r.doc_id), [tuple(s) for s in r.base], [tuple(s) for s in r.added]) for r in df.collect()
    )


def test_base_equals_the_stated_forms_on_given_texts():
    texts = [
        "a@b.c_d@e.f x@y@z.com @no.name name@nohost me@host.com. a.b%c+d-e_f@x-y.co.uk!",
        "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3 11.22.33.44.",
        "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 1111 1111 9807915762804490",
        "+1 (017) 555-7713 rest +1-2 +12345678901234567 +49 30 1234567. ++1 23456789 +(0)12345678",
        "Ünï 漢字 é@é.com ñx@y.es 😀+1 (017) 555-7713😀 1.1.1.1",
    ]
    for text in texts:
        assert sure_entities(text) == plain_base(text), text


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="01259 .-+()@abZ_%é\n", max_size=60))
def test_base_equals_the_stated_forms_on_any_text(text):
    assert sure_entities(text) == plain_base(text)


@pytest.mark.parametrize(
    "text", ["x" * 1_000_000, "1" * 1_000_000, "1." * 500_000, "+1" * 300_000, "@a" * 300_000, "a@" * 300_000,
             "(1" * 300_000, "1-1 " * 200_000, "[at]" * 200_000, "+1 " + " " * 500_000]
)
def test_long_runs_take_time_in_proportion(text):
    start = time.process_time()
    entities(text)
    assert time.process_time() - start < 20


def test_luhn():
    assert passes_luhn("4111111111111111") and not passes_luhn("4111111111111112")


def test_candidates_overlap_nothing():
    text = "+1 (017) 555-7713 or (017) 555-7714, me [at] host [dot] com, you@localhost, +12 345 67 (at) x"
    taken = [span for _, *span in sure_entities(text)]
    found = [text[a:b] for _, a, b in candidates(text, taken)]
    assert found == ["(017) 555-7714", "me [at] host [dot] com", "you@localhost", "+12 345 67"]


CALLS = [(i, f"Please call me: +1 (20{i}) 555-010{i} today. Word{i} here.", "en", "a") for i in range(8)]


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    rows = CALLS + [
        (20, "Please call me: 555 0177 today, or write.", "en", "a"),
        (21, "The number 5550177 is new and 1234567 is none.", "en", "a"),
        (22, "Nothing of the kind in 1234567890 here.", "en", "a"),
    ]
    found = {r.doc_id: r for r in personal_data(documents(spark, rows)).collect()}
    assert [tuple(s) for s in found[20].added] == [("phone", 16, 24)]
    assert [tuple(s) for s in found[21].added] == [("phone", 11, 18)]  # the same number, written otherwise
    assert found[22].added == [] and found[0].added == []
    assert sorted((str(k), b, a) for k, b, a in plain_spans(rows)) == found_spans(personal_data(documents(spark, rows)))


def test_a_sure_identifier_is_found_however_it_is_written(spark):
    rows = [(1, "mail jo.doe@host.example.com now", "en", "a"), (2, "Jo.Doe [at] host [dot] example [dot] com", "en", "a")]
    found = {r.doc_id: [tuple(s) for s in r.added] for r in personal_data(documents(spark, rows)).collect()}
    assert found == {1: [], 2: [("email", 0, 40)]}


def test_copies_are_no_support(spark):
    rows = [(i, "Please call me: +1 (201) 555-0101 today", "en", "a") for i in range(50)]
    rows.append((99, "Please call me: 555 0177 today", "en", "a"))
    assert all(r.added == [] for r in personal_data(documents(spark, rows)).collect())


def test_doubtful_contexts_find_nothing(spark):
    others = [(100 + i, f"Please call me: 99000{i:02d} today", "en", "a") for i in range(4)]
    assert all(r.added == [] for r in personal_data(documents(spark, CALLS + others)).collect())


def test_rounds_reach_further(spark):
    """A pattern that seeds alone do not support is supported by what an earlier round found."""
    first = [(i, f"call me: +1 (20{i}) 555-010{i} {'or' if i > 3 else 'and'}", "en", "a") for i in range(8)]
    second = [(20 + i, f"call me: 555 02{i:02d} or; dial 555 02{i:02d} then", "en", "a") for i in range(2)]
    third = [(40 + i, f"dial +1 (30{i}) 555-020{i} then", "en", "a") for i in range(4)]
    last = [(60, "dial 555 0999 then", "en", "a")]
    rows = first + second + third + last
    once = {r.doc_id: r.added for r in personal_data(documents(spark, rows), rounds=1).collect()}
    more = {r.doc_id: r.added for r in personal_data(documents(spark, rows), rounds=3).collect()}
    assert once[60] == [] and [tuple(s) for s in more[60]] == [("phone", 5, 13)]
    assert sorted((str(k), b, a) for k, b, a in plain_spans(rows)) == found_spans(personal_data(documents(spark, rows)))


def test_patterns_are_told_with_support_and_confidence(spark):
    met = scan(documents(spark, CALLS)).select(queries.F.inline("met"))
    scores, patterns = bootstrap(met)
    told = {r.pattern: r for r in patterns.collect()}
    assert told["number: me: *"].kind == "phone" and told["number: me: *"].support == 8
    assert {r.score for r in scores.collect()} == {1.0}


def test_odd_rows_equal_brute_force(spark, tricky):
    rows = TRICKY + [(r[0], f"{r[1]} Please call me: 555 01{i:02d} now", *r[2:]) for i, r in enumerate(CALLS[:1])] + CALLS
    more = documents(
        spark, rows, row="x", base=1, added=2, t0=3, t1=4, met=5, kind="k", start=6, end=7, instance="i", key="k"
    )
    expected = sorted((str(k), b, a) for k, b, a in plain_spans(rows))
    assert any(a for _, _, a in expected)
    assert found_spans(personal_data(more)) == expected
    assert personal_data(tricky).count() == len(TRICKY)


def test_an_empty_table_gives_an_empty_one(nothing):
    assert personal_data(nothing).count() == 0
    assert mask_personal_data(nothing).count() == 0


def test_masked_texts(spark):
    rows = CALLS + [(20, "Please call me: 555 0177 today", "en", "a"), (None, "at 1.2.3.4, a@b.co", "en", "a"), (3, None, "en", "a")]
    masked = mask_personal_data(documents(spark, rows, h0=1, found_spans=2, t0=3))
    assert masked.columns == documents(spark, rows, h0=1, found_spans=2, t0=3).columns
    texts = sorted(r.text for r in masked.collect())
    assert "Please call me: [PHONE] today" in texts and "at [IP], [EMAIL]" in texts and "" in texts
    assert len(texts) == len(rows)
    assert mask("+4111111111111111", [{"kind": "card", "start": 1, "end": 17}]) == "+[CARD]"


def test_query_states_base_and_spans(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = queries.op13_pii(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs) and any(r.n_email for r in rows) and any(r.n_card for r in rows)
    for r in rows:
        base = plain_base(docs[r.doc_id])
        told = [f"{k}:{a}:{b}" for k, a, b in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, *_ in base) for kind in KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        spans = [s for s in r.spans.split(",") if s]
        assert set(told) <= set(spans)
        order = [(KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert order == sorted(order)
