import random

import numpy as np
import pytest
from helpers import TRICKY, documents

from gradewise.llm.substring_dedup import (
    GEAR,
    MOST_BYTES,
    STEPS,
    WINDOW,
    WORDS_PER_CHUNK,
    chunk_ends,
    drop_repeated_passages,
    gear_hashes,
)
from gradewise.llm.text import SPACES


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghiklmnoprstuvw", k=rng.randint(1, 9))) for _ in range(n))


def chunks(text):
    raw = text.encode()
    ends, _ = chunk_ends(raw)
    return [raw[a:b].decode() for a, b in zip([0, *ends[:-1]], ends)]


def test_gear_hash_is_the_rolling_one():
    raw = np.frombuffer(prose(random.Random(1), 300).encode(), np.uint8)
    for at, found in enumerate(gear_hashes(raw)):
        h = 0
        for byte in raw[max(0, at + 1 - 2**STEPS) : at + 1]:
            h = ((h << 1) + int(GEAR[byte])) % 2**32
        assert h == found


@pytest.mark.parametrize("text", [t for _, t, *_ in TRICKY if t])
def test_chunks_are_the_text_again(text):
    parts = chunks(text)
    assert "".join(parts) == text
    assert all(len(p.encode()) < MOST_BYTES + 4 for p in parts)  # a character may reach over the cut
    ends, words = chunk_ends(text.encode())
    assert words.sum() == len([w for w in text.translate({ord(c): 32 for c in SPACES}).split(" ") if w])


def test_chunks_are_about_as_long_as_wanted():
    parts = chunks(prose(random.Random(2), 60_000))
    assert 60_000 / len(parts) == pytest.approx(WORDS_PER_CHUNK, rel=0.1)


def test_ends_resist_insertions():
    rng = random.Random(3)
    text = prose(rng, 2_000)
    moved = text[:3_000] + "an insertion " + text[3_000:]
    before, after = chunks(text), chunks(moved)
    assert len(set(before) - set(after)) <= 3 and before[-100:] == after[-100:]


def found(spark, rows):
    return {r.doc_id: r for r in drop_repeated_passages(documents(spark, rows)).collect()}


def test_passages_of_over_fifty_words_go_from_all_but_one(spark):
    rng = random.Random(4)
    passages = [prose(rng, rng.randint(51, 120)) for _ in range(60)]
    rows, holders = [], {}
    for i in range(400):
        if i % 2:
            which = i % 60
            rows.append((i, f"{prose(rng, rng.randint(0, 80))} {passages[which]} {prose(rng, rng.randint(0, 80))}", "en", "a"))
            holders.setdefault(which, []).append(i)
        else:
            rows.append((i, prose(rng, rng.randint(1, 200)), "en", "a"))
    kept = found(spark, rows)
    for i, text, *_ in rows:
        if i % 2 == 0 or holders[i % 60][0] == i:
            assert kept[i].n_dropped_words == 0 and kept[i].kept_text == text
        else:
            assert passages[i % 60] not in kept[i].kept_text
            assert kept[i].n_dropped_words >= 16
            assert set(kept[i].kept_text.split()) <= set(text.split())


def test_whole_copies_lose_everything_but_once(spark):
    text = prose(random.Random(5), 90)
    kept = found(spark, [(i, text, "en", "a") for i in (7, 3, 9)])
    assert {i: r.kept_text for i, r in kept.items()} == {3: text, 7: "", 9: ""}


def test_short_repeats_stay(spark):
    rng = random.Random(6)
    line = prose(rng, 10)
    rows = [(i, f"{prose(rng, 40)} {line} {prose(rng, 40)}", "en", "a") for i in range(50)]
    assert all(r.n_dropped_words == 0 for r in found(spark, rows).values())


def test_tricky_rows(tricky):
    kept = drop_repeated_passages(tricky).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(r[0]) for r in TRICKY)
    texts = {str(r.doc_id): r.kept_text for r in kept}
    assert texts["3"] == texts["4"] == "" and texts["8"] == TRICKY[9][1] and texts["10"] == TRICKY[11][1]


def test_a_passage_that_all_rows_hold(spark):
    passage = prose(random.Random(7), 60)
    rows = [(i, f"{passage} own{i} word{i}", "en", "a") for i in range(1_000)]
    kept = found(spark, rows)
    assert kept[0].n_dropped_words == 0 and all(kept[i].n_dropped_words >= 16 for i in range(1, 1_000))


def test_an_empty_table_gives_an_empty_one(nothing):
    assert drop_repeated_passages(nothing).count() == 0


def test_no_passage_of_over_fifty_words_is_missed(spark):
    rng = random.Random(8)
    passages = [prose(rng, rng.randint(51, 60)) for _ in range(3_000)]
    rows = [
        (i, f"{prose(rng, rng.randint(0, 30))} {passages[i % 3_000]} {prose(rng, rng.randint(0, 30))}", "en", "a")
        for i in range(6_000)
    ]
    kept = found(spark, rows)
    assert all(kept[i].n_dropped_words == 0 for i in range(3_000))
    assert all(kept[i].n_dropped_words >= 16 for i in range(3_000, 6_000))
    left = [len(passages[i % 3_000].split()) - kept[i].n_dropped_words for i in range(3_000, 6_000)]
    assert max(left) <= 13 + 24 and np.mean(left) < 10  # as the docstring bounds them


def test_only_repeated_words_go(spark):
    """Every 16 words that a later text loses stand in an earlier one."""
    rng = random.Random(9)
    passage = prose(rng, 300).split()
    rows = []
    for i in range(60):
        a = rng.randint(0, 200)
        rows.append((i, f"{prose(rng, 20)} {' '.join(passage[a : a + 80])} {prose(rng, 20)}", "en", "a"))
    kept = found(spark, rows)
    for i, text, *_ in rows:
        own = [w for w in text.split() if w not in passage]
        assert [w for w in kept[i].kept_text.split() if w not in passage] == own
        assert len(kept[i].kept_text.split()) == len(text.split()) - kept[i].n_dropped_words
    assert set(passage) & {w for r in kept.values() for w in r.kept_text.split()} == {
        w for w in passage if any(w in t.split() for _, t, *_ in rows)
    }


def unspaced(rng, letters, n):
    return "".join(rng.choices(letters, k=n))


HAN = [chr(c) for c in range(0x4E00, 0x5200)]
THAI = [chr(c) for c in range(0x0E01, 0x0E2F)]
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


@pytest.mark.parametrize("letters, n", [(HAN, 100), (THAI, 100), (BASE64, 300)])
def test_unspaced_passages_go_from_all_but_one(spark, letters, n):
    rng = random.Random(10)
    passages = [unspaced(rng, letters, n) for _ in range(100)]
    rows = [
        (i, f"{unspaced(rng, letters, rng.randint(0, 500))}{passages[i % 100]}{unspaced(rng, letters, rng.randint(0, 500))}", "zh", "a")
        for i in range(400)
    ]
    rows += [(1_000 + i, passages[i], "zh", "a") for i in range(100)]
    rows += [(2_000 + i, unspaced(rng, letters, 700), "zh", "a") for i in range(100)]
    kept = found(spark, rows)
    for i, text, *_ in rows:
        if i < 100 or i >= 2_000:
            assert kept[i].kept_text == text and kept[i].n_dropped_words == 0
        else:
            at = text.index(passages[i % 100])
            assert len(kept[i].kept_text) <= len(text) - n * 0.3 and kept[i].n_dropped_words >= 16
            # letters next to the passage may be the same elsewhere by chance
            assert kept[i].kept_text.startswith(text[: max(0, at - 3)]) and kept[i].kept_text.endswith(text[at + n + 3 :])


def test_whole_unspaced_copies_lose_everything_but_once(spark):
    text = unspaced(random.Random(11), HAN, 90) + "\n" + unspaced(random.Random(12), HAN, 900)
    kept = found(spark, [(i, text, "zh", "a") for i in (7, 3, 9)])
    assert {i: r.kept_text for i, r in kept.items()} == {3: text, 7: "", 9: ""}


def test_a_cut_in_a_long_word_glues_no_words(spark):
    rng = random.Random(13)
    passage = unspaced(rng, BASE64, 300)
    rows = [(i, f"word{i} {unspaced(rng, BASE64, 50)}{passage} next{i} and more", "en", "a") for i in range(5)]
    kept = found(spark, rows)
    for i in range(1, 5):
        assert kept[i].kept_text.split()[0] == f"word{i}" and kept[i].kept_text.split()[-3:] == [f"next{i}", "and", "more"]


def slow_chunks(words):
    """Chunks of a text of short words parted by single spaces, by the plain rules."""
    raw, at, hashes = " ".join(words).encode(), -1, []
    for word in words:
        at += len(word) + 1
        h = 0
        for byte in raw[max(0, at - 2**STEPS) : at]:
            h = ((h << 1) + int(GEAR[byte])) % 2**32
        hashes.append(h)
    closes = set()
    for first in range(len(words) - WINDOW + 1):
        closes.add(min(range(first, first + WINDOW), key=lambda i: (hashes[i], -i)))
    parts, own = [], []
    for i, word in enumerate(words):
        own.append(word)
        if i in closes or i == len(words) - 1:
            parts.append(own)
            own = []
    return parts


def slow_runs(parts, min_words):
    """First chunk and the one past the last of every run that has a digest."""
    runs = set()
    for first in range(len(parts)):
        for past in range(first + 1, len(parts) + 1):
            if sum(map(len, parts[first:past])) >= min_words:
                runs.add((first, past))
                break
    for first in reversed(range(len(parts))):
        if sum(map(len, parts[first:])) >= min_words:
            runs.add((first, len(parts)))
            break
    return runs


def test_results_equal_the_slow_version(spark):
    rng = random.Random(14)
    pool = [prose(rng, rng.randint(5, 60)).split() for _ in range(40)]
    rows = []
    for i in range(300):
        words = [w for _ in range(rng.randint(0, 6)) for w in rng.choice([prose(rng, rng.randint(1, 30)).split(), rng.choice(pool)])]
        rows.append((rng.choice([i, i // 2, None]), " ".join(words) or rng.choice([None, ""]), "en", "a"))
    owners = {}  # runs are the same if their words are, wherever their inner chunks end
    for key, text, *_ in rows:
        parts = slow_chunks((text or "").split())
        for first, past in slow_runs(parts, 16):
            owners.setdefault(" ".join(sum(parts[first:past], [])), []).append(key)
    wanted = []
    for key, text, *_ in rows:
        parts = slow_chunks((text or "").split())
        gone = set()
        for first, past in slow_runs(parts, 16):
            known = [k for k in owners[" ".join(sum(parts[first:past], []))] if k is not None]
            if known and key != min(known):
                gone |= set(range(first, past))
        left = [w for n, part in enumerate(parts) if n not in gone for w in part]
        wanted.append((key is None, key or 0, len(gone), sum(len(parts[n]) for n in gone), left))
    rows_found = drop_repeated_passages(documents(spark, rows)).collect()
    got = [(r.doc_id is None, r.doc_id or 0, r.n_dropped_chunks, r.n_dropped_words, r.kept_text.split()) for r in rows_found]
    assert sorted(got) == sorted(wanted) and sum(w[2] for w in wanted) > 100
