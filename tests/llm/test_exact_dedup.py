import hashlib
import re
from collections import Counter

import numpy as np
from helpers import docs
from hypothesis import given
from hypothesis import strategies as st

from tidewright.llm import exact_dedup as op
from tidewright.llm.queries import op1_exact_dedup

NORM = re.compile(r"[\x20\x09-\x0D]+")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(NORM.sub(" ", t or ""), []).append(i)
    out = []
    for body, ids in groups.items():
        keep = min(ids, key=lambda i: (i is None, i))
        sha = hashlib.sha256(body.encode()).hexdigest()
        for n, i in enumerate(sorted(ids, key=lambda i: (i is None, i or 0))):
            out.append((i, keep, len(ids), n == 0, sha))
    return Counter(out)


def found(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


ROWS = [(5, "a  b"), (2, "a\tb"), (9, "a b "), (1, None), (3, ""), (4, " \n"), (6, " "), (7, "x" * 200_000),
        (8, "x" * 200_000), (None, "a b"), (None, "only"), (10, "é\x0b\x0cé"), (11, "é é"), (12, "a\xa0b")]


def test_cases_against_brute_force(spark):
    assert found(op.exact_dedup(docs(spark, ROWS))) == brute(ROWS)


def test_repeated_rows_keep_one(spark):
    rows = [(1, "a b"), (1, "a b"), (2, "a  b"), (3, "c"), (3, "c"), (4, "d")]
    assert found(op.exact_dedup(docs(spark, rows))) == brute(rows)
    assert sorted(r.doc_id for r in op.without_copies(docs(spark, rows)).collect()) == [1, 3, 4]


def test_empty_table(spark):
    assert op.exact_dedup(docs(spark, [])).collect() == []
    assert op.without_copies(docs(spark, [])).collect() == []


def test_clashing_columns_pass_through(spark):
    df = docs(spark, ROWS).selectExpr("*", "'k' AS kept", "1 AS row", "2 AS sha__", "3 AS body", "4 AS fingerprint")
    out = op.without_copies(df)
    assert out.columns == df.columns
    expected = sorted(str(i) for (i, _, _, kept, _), n in brute(ROWS).items() if kept)
    assert sorted(str(r.doc_id) for r in out.collect()) == expected


@given(st.lists(st.integers(0, (1 << 64) - 1) | st.sampled_from([0, 1, (1 << 64) - 1]), min_size=1))
def test_filter_round_trip_and_merge(values):
    values = np.array(values, np.uint64)
    expected = Counter(values.tolist())
    got, counts = op.read_filter(op.build_filter(values))
    assert dict(zip(got.tolist(), counts.tolist())) == expected and (np.diff(got.astype(object)) > 0).all()
    half = len(values) // 2
    parts = [op.build_filter(v) for v in (values[:half], values[half:])]
    got, counts = op.merge_filters(parts)
    assert dict(zip(got.tolist(), counts.tolist())) == expected


@given(st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85\xa0ab", max_size=12))
def test_normalised(text):
    assert op.normalised(text.encode()) == NORM.sub(" ", text).encode()


def test_query_on_the_whole_table(spark, table):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    assert found(op1_exact_dedup(spark, "/root/testdata/sf0.001")) == brute(rows)
