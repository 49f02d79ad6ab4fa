import random
import re
from collections import Counter, defaultdict

from helpers import DOCS, by_id, docs
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np
import pyarrow as pa
from tidewright.llm import quality_rules as op
from tidewright.llm.queries import op13_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again), len(lines)


def brute(rows, least_rows=200):
    """rows: (doc_id, lang, source, text); a sorted list of (doc_id, counts, base_failed, failed_rules)."""
    facts = []
    for i, lang, source, text in rows:
        c = counts(text)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        values = [
            (1000 * c[2] // max(c[1], 1), 15), (1000 * c[3] // max(c[5], 1), 50),
            (1000 * c[4] // max(c[0], 1), 50), (100 * c[1] // max(c[0], 1), 30),
        ]
        facts.append((i, lang, source, c, failed, values))
    groups = defaultdict(list)
    for _, lang, source, _, failed, values in facts:
        if not failed:
            for key in [(lang, source), (lang,), ()]:
                groups[key].append(values)

    def top(v):  # the largest value of the bin of v
        octave = max(v.bit_length() - 6, 0)
        return v if v < 64 else (((v >> octave) + 1) << octave) - 1

    def fence(key, m):
        found = sorted(v[m][0] for v in groups[key])
        q1, q3 = (top(found[-(-q * len(found) // 4) - 1]) for q in (1, 3))
        step = 3 * max(q3 - q1, groups[key][0][m][1])
        return q1 - step, q3 + step

    out = []
    for i, lang, source, c, failed, values in facts:
        broken = []
        if not failed:
            keys = [(lang, source), (lang,), ()]
            key = next((k for k in keys[:2] if len(groups[k]) >= least_rows), ())
            for m, name in enumerate(["symbols", "repeated_lines", "repeated_words", "word_length"]):
                low, high = fence(key, m)
                if values[m][0] > high or (name == "word_length" and values[m][0] < low):
                    broken.append(name)
        out.append((i, *c, failed, ",".join(sorted(broken)), not failed and not broken))
    return sorted(out, key=str)


def found(df):
    names = ["doc_id", *op.COUNTS, "base_failed", "failed_rules", "kept"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, la, s, len(t or "")) for i, la, s, t in rows], DOCS).repartition(3)


def some(rng, n, lang, source, first, symbols=0.0):
    rows = []
    for i in range(n):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(40, 90))]
        words = [w + "#$" * (rng.random() < symbols) for w in words]
        text = " ".join(words) + "\n" + "\n".join(rng.choice([" same line ", "one two"]) for _ in range(rng.randint(0, 6)))
        rows.append((first + i, lang, source, text))
    return rows


def test_groups_of_different_habits(spark):
    """A source that uses symbols keeps its texts; elsewhere such a text goes."""
    rng = random.Random(3)
    rows = some(rng, 40, "en", "code", 0, 0.5) + some(rng, 40, "en", "news", 100) + some(rng, 3, "en", "small", 200, 0.5)
    rows += some(rng, 30, None, None, 300) + some(rng, 2, "fr", None, 400, 0.9) + some(rng, 4, "en", "news", 500, 0.9)
    out = op.judge(frame(spark, rows), least_rows=20)
    assert found(out) == brute(rows, 20)
    kept = {i: r[0] for i, r in by_id(out.where("not base_failed"), "kept").items()}
    assert all(k for i, k in kept.items() if i < 40) and not any(k for i, k in kept.items() if i >= 500)


ODD = [None, "", " \n\t", "a", "a b c a b c", "#*$%&|<> é\x1cx   \x85", "x\n x\nx\nx", "a a a a", "l\r\nl\r\n" * 40, "w " * 60]


def test_odd_texts_ties_repeats_and_long_ones(spark):
    rng = random.Random(4)
    long = " ".join("".join(rng.choices("abc", k=3)) for _ in range(400_000))
    rows = [(i, "en", "s", t) for i, t in enumerate([*ODD, long, "é" * 9 + " ü" * 70])]
    rows += [(None, None, "s", t) for t in ODD[:4]] + [(3, "en", "s", "a")] * 3 + some(rng, 9, "en", "s", 50)
    assert found(op.judge(frame(spark, rows))) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert op.judge(docs(spark, [])).collect() == []
    rows = some(random.Random(1), 12, "en", "a", 0)
    df = frame(spark, rows).selectExpr("*", "1 AS n_words", "2 AS kept", "3 AS bin", "'x' AS measure", "4 AS level", "5 AS n")
    assert found(op.judge(df, least_rows=3)) == brute(rows, 3)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85\xa0#ab", max_size=40), min_size=1, max_size=6))
def test_counts_of_any_texts(texts):
    column = pa.array(texts, pa.string())
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    got = np.stack(op.count_texts(column, data, offsets), axis=1)
    assert [tuple(r) for r in got.tolist()] == [counts(t) for t in texts]


def test_bins_and_merging(spark):
    values = [0, 1, 63, 64, 65, 127, 128, 1000, 12345, 10**6, 2**40 + 12345]
    rows = spark.createDataFrame([(v,) for v in values], "value bigint").selectExpr("value", f"{op.bin_of('value')} AS bin")
    for v, b, top in rows.selectExpr("value", "bin", f"{op.top_of('bin')} AS top").collect():
        assert v <= top <= v + v // 32


def test_query_on_the_whole_table(spark, table):
    rows = [tuple(r) for r in table(spark, "documents").select("doc_id", "lang", "source", "text").collect()]
    assert found(op13_quality_rules(spark, "/root/testdata/sf0.001")) == brute(rows)
