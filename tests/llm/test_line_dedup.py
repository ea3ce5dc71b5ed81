from collections import defaultdict

import pytest

from gradewise.llm.line_dedup import drop_shared_lines
from gradewise.llm.text import LOWER, SPACES, UPPER
from helpers import TRICKY, documents

FOLD = str.maketrans(UPPER, LOWER)
FOOTER = "All rights of this page are reserved"


def brute_force(rows, min_chars=20, min_docs=3):
    def key_of(line):
        return line.strip(SPACES).translate(FOLD)

    split = [(key, (text or "").split("\n")) for key, text, *_ in rows]
    holders = defaultdict(list)
    for key, lines in split:
        for line in {key_of(x) for x in lines}:
            holders[line].append(key)
    keepers = {
        line: max((k for k in keys if k is not None), default=None)
        for line, keys in holders.items()
        if len(line) >= min_chars and len(keys) >= min_docs
    }
    out = []
    for key, lines in split:
        kept = [x for x in lines if key_of(x) not in keepers or keepers[key_of(x)] == key]
        out.append((key, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(map(str, out))


def found(df):
    return sorted(str(tuple(r)) for r in df.collect())


def footers(n):
    for i in range(n):
        yield (i, f"own line of document {i}\n  {FOOTER.upper()} \t\nshort\n{FOOTER}\nlast", "en", "a")


@pytest.mark.parametrize("rows", [TRICKY, list(footers(2)), list(footers(3)), list(footers(300))])
def test_equals_brute_force(spark, rows):
    assert found(drop_shared_lines(documents(spark, rows))) == brute_force(rows)


def test_clashing_columns_play_no_part(tricky):
    assert found(drop_shared_lines(tricky)) == brute_force(TRICKY)


def test_shared_line_stays_in_the_largest_key_only(spark):
    kept = {r.doc_id: r for r in drop_shared_lines(documents(spark, list(footers(5)))).collect()}
    assert [kept[i].n_dropped for i in range(5)] == [2, 2, 2, 2, 0]
    assert kept[0].kept_text == "own line of document 0\nshort\nlast"


def test_document_that_loses_all_its_lines_is_empty(spark):
    rows = [(i, FOOTER, "en", "a") for i in range(4)]
    kept = {r.doc_id: r.kept_text for r in drop_shared_lines(documents(spark, rows)).collect()}
    assert kept == {0: "", 1: "", 2: "", 3: FOOTER}


def test_an_empty_table_gives_an_empty_one(nothing):
    assert drop_shared_lines(nothing).count() == 0
