import random
import re

import pytest

from helpers import by_id, docs
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np
from tidewright.llm import substring_dedup as op
from tidewright.llm.text import Words, windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size=20):
    """Per (id, text): n_words, n_removed, kept text."""
    seen, out = {}, {}
    for i, t in sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is None, r[0] or 0)):
        words = WORD.findall(t)
        gone = set()
        for p in range(len(words) - size + 1):
            if seen.setdefault(tuple(words[p : p + size]), (i, t, p)) != (i, t, p):
                gone.update(range(p, p + size))
        out[i, t] = len(words), len(gone), " ".join(w for p, w in enumerate(words) if p not in gone)
    return out


def found(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in df.collect()}


def check(spark, rows, **options):
    size = options.get("window", 20)
    assert found(op.substring_dedup(docs(spark, rows), **options)) == {
        i: v for (i, _), v in brute(rows, size).items()
    }


def sample(n, seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passages = [" ".join(rng.choices(words, k=rng.randint(18, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 80))) for _ in range(3)]
        rows.append((i, (" " * rng.randint(1, 2)).join(parts[:1] + rng.choices(passages, k=rng.randint(0, 3)) + parts[1:])))
    return rows


def test_shared_passages(spark):
    check(spark, sample(120, 1))


def test_small_alphabet_and_periods(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices("ab", weights=[9, 1], k=rng.randint(0, 60)))) for i in range(60)]
    check(spark, rows + [(100, "a " * 90), (101, "a " * 21), (102, "b a " * 40)])
    check(spark, rows, window=9, gram=3)


def test_cases(spark):
    line = " ".join(f"x{k}" for k in range(25))
    rows = [(4, line), (2, f"{line}\n{line}"), (None, line), (7, None), (8, ""), (9, " \t"), (10, line.replace(" ", " "))]
    rows += [(11, "y" * 300_000 + " " + line), (12, " ".join(f"z{k}" for k in range(19)))]
    check(spark, rows)


def test_repeated_rows_are_one_document(spark):
    line = " ".join(f"x{k}" for k in range(25))
    rows = op.substring_dedup(docs(spark, [(1, line), (1, line), (2, line)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(1, 0), (1, 0), (2, 25)]


def test_empty_table_and_clashing_columns(spark):
    assert op.substring_dedup(docs(spark, [])).collect() == []
    rows = sample(20, 3)
    df = docs(spark, rows).selectExpr("*", "1 AS rank", "2 AS tag", "3 AS places", "4 AS slice")
    assert found(op.substring_dedup(df)) == {i: v for (i, _), v in brute(rows).items()}


def test_intervals_are_maximal(spark):
    line = " ".join(f"x{k}" for k in range(30))
    rows = {r.doc_id: r for r in op.substring_dedup(docs(spark, [(1, line), (2, f"a {line} b {line}")])).collect()}
    assert [tuple(s) for s in rows[2].intervals] == [(1, 31), (32, 62)]


TEXTS = st.lists(st.text(alphabet="ab \t\n\x0b\x1cé\xa0", max_size=20) | st.just("long" * 20), max_size=6)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 6))
def test_words_and_windows(texts, size):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    words = Words(data, offsets)
    expected = [t.encode().split() for t in texts]
    assert [bytes(data[a:b]) for a, b in zip(words.start, words.end)] == sum(expected, [])
    assert words.first.tolist() == np.cumsum([0] + [len(w) for w in expected]).tolist()
    flat, hashes = sum(expected, []), words.hashes()
    assert len(set(hashes.tolist())) == len(set(flat))
    found = windows(hashes, size).tolist()
    grams = [tuple(flat[i : i + size]) for i in range(max(0, len(flat) - size + 1))]
    assert len(found) == len(grams) and len(set(zip(found, grams))) == len(set(found)) == len(set(grams))


def thue_morse(n, swap=False):
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_of_patterns_that_powers_of_one_base_confuse(spark, n):
    rows = [(i, " ".join(["w"] * 19 + [thue_morse(n, i == 1)])) for i in range(2)]
    rows += [(2, " ".join(f"{thue_morse(n, k % 2)}{k}" for k in range(30)))]
    assert by_id(op.substring_dedup(docs(spark, rows)), "n_removed") == {0: (0,), 1: (0,), 2: (0,)}


def test_words_computed_to_collide_under_a_fixed_key(spark):
    pair = "tvnevfseswqcodyjdbzysdgsinhzwahemxujlvssigzfacub", "vpnxzixtprggqkcxlggadltrwblbnhfcvyxspyxglmazybul"
    same = " ".join(f"w{k}" for k in range(19))
    rows = [(i, f"{same} {word}") for i, word in enumerate(pair)]
    assert [r.n_removed for r in op.substring_dedup(docs(spark, rows)).orderBy("doc_id").collect()] == [0, 0]
