import re

import pytest
from helpers import TRICKY, documents

from gradewise.llm.decontamination import cut_leaks, drop_leaks, find_leaks
from gradewise.llm.text import LOWER, UPPER

FOLD = str.maketrans(UPPER, LOWER)
ITEM = "Which of these seven rivers flows through the old town of Straßburg, and where does it end?"
ITEMS = [(1, ITEM), (2, "tiny item"), (3, None), (4, "..."), (5, "eight nine ten eleven"), (None, "line two"), (1, ITEM)]
LEAKY = [
    (30, f"Intro words. {ITEM.upper().replace('SS', 'ß')} And more.", "en", "a"),
    (31, " ".join(ITEM.split()[:9]), "en", "a"),
    (32, f"{ITEM} {ITEM} a tiny, item!", "en", "a"),
    (33, "tiny items", "en", "a"),
    (34, " ".join(ITEM.split()[3:14]) + " and so on", "en", "a"),
]


def words_of(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD)) if w]


def brute_force(rows, items=ITEMS, size=10):
    windows = set()
    for item, text in items:
        words = words_of(text)
        step = min(size, len(words))
        windows |= {(item, tuple(words[i : i + step])) for i in range(len(words) - step + 1) if words}
    out = []
    for key, text, *_ in rows:
        words, hit, ids = words_of(text), set(), set()
        for item, window in windows:
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    ids |= {str(item)} if item is not None else set()
        out.append(str((key, len(words), len(hit), sorted(ids))))
    return sorted(out)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def found(df):
    return sorted(str((r.doc_id, r.leaks.n_words, r.leaks.n_hit, list(r.leaks["items"]))) for r in df.collect())


@pytest.mark.parametrize("most", [2_000_000, 3])
def test_equals_brute_force(spark, items, most):
    rows = TRICKY + LEAKY
    assert found(find_leaks(documents(spark, rows), items, max_windows=most)) == brute_force(rows)


def test_clashing_columns_play_no_part(tricky, items):
    assert found(find_leaks(tricky, items)) == brute_force(TRICKY)


def test_hits_name_the_bytes(spark, items):
    for r in find_leaks(documents(spark, LEAKY), items).collect():
        for hit in r.leaks.hits:
            own = r.text.encode()[hit.start : hit.stop].decode()
            assert words_of(own) == words_of(r.text)[hit.first : hit.last]


def test_documents_with_leaks_go_and_clean_ones_stay_as_they_are(spark, items):
    docs = documents(spark, LEAKY, leaks=1)
    kept = drop_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [31, 33]


def test_spans_are_cut_and_the_rest_stays(spark, items):
    docs = documents(spark, [*LEAKY, (40, None, "en", "a")])
    cut = {r.doc_id: r.text for r in cut_leaks(docs, items).collect()}
    assert cut[30] == "Intro words. ? And more."
    assert cut[31] == LEAKY[1][1] and cut[40] is None
    assert not any("Straßburg" in (t or "") for t in cut.values() if t != LEAKY[1][1])


def test_empty_tables(spark, tricky, nothing, items):
    assert find_leaks(nothing, items).count() == 0
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert found(find_leaks(tricky, none)) == brute_force(TRICKY, [])
    assert drop_leaks(tricky, none).count() == tricky.count()


def test_one_piece_is_held_at_a_time(spark, items):
    """Whatever the number of pieces, one scan stands between what is written and what is read."""
    scans = {}
    for most in (2_000_000, 2):
        plan = find_leaks(documents(spark, LEAKY), items, max_windows=most)._jdf.queryExecution().executedPlan().toString()
        scans[most] = plan.count("ArrowEvalPython")
    assert scans[2_000_000] == scans[2] == 1
