"""Quality rules whose cutoffs follow the data: quantile sketches per language and source.

A task counts words, symbols, repeated lines and repeated 3-word windows of whole
texts; words and lines are told apart by their bytes, through Arrow's dictionaries,
not by hashes. From the counts follow four measures, all integers: symbols and
repeated words and lines in thousandths, and letters a word in hundredths.

A sketch holds counts of log-linear bins: exact up to ``2 * PER_OCTAVE``, then
``PER_OCTAVE`` bins for each doubling, so that a quantile is at most 1/32 too large.
Sketches merge by adding counts: those of (lang, source) add up to those of the
languages, and these to that of the whole table. They are counted in each task
before anything is shuffled, and depend on neither order nor partitioning.

A group's quartiles set its fences, ``FENCE`` times the distance of the quartiles (a
measure's ``spread`` at least) outside them. A group of fewer than ``LEAST_ROWS``
rows takes the fences of its language, a small language those of the table. The fences
are joined to the rows by language and source. Only rows that pass the base rules
are sketched and judged.

Cases: null and empty texts have no words and fail the base rules. A null language or
source is a value like any other. Ids are not looked at: null and equal ones each keep
their row. A measure that is equal to a fence passes. Very long texts are handled
alone. An empty table gives an empty result; columns other than the four named are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import prepare, small_side, written
from tidewright.llm.text import SPACE, chunks, returning

PER_OCTAVE = 32
FENCE = 3
LEAST_ROWS = 200
LEAST_WORDS = 50
MOST_REPEATED = 50  # in hundredths of the words

# The characters counted as symbols.
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
# Bytes that begin a character.
_FIRST = (np.arange(256) & 0xC0) != 0x80


@dataclass(frozen=True)
class Measure:
    """``times * part / whole`` as an integer. ``spread`` is the least distance of the
    quartiles that is assumed; ``low`` says whether small values fail too."""

    name: str
    part: str
    whole: str
    times: int
    spread: int
    low: bool = False

    def value(self) -> Column:
        return F.expr(f"{self.times} * {self.part} div greatest({self.whole}, 1)")


MEASURES = (
    Measure("symbols", "n_symbols", "word_chars", 1000, 15),
    Measure("repeated_lines", "n_dup_lines", "n_lines", 1000, 50),
    Measure("repeated_words", "n_repeat_words", "n_words", 1000, 50),
    Measure("word_length", "word_chars", "n_words", 100, 30, low=True),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _pieces(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """(text, piece) of each piece that holds a word."""
    parents, flat = pc.list_parent_indices(lists), pc.list_flatten(lists)
    some = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(flat)), 0)
    return parents.filter(some).to_numpy().astype(np.int64), flat.filter(some)


def _codes(pieces: pa.Array) -> tuple[np.ndarray, int]:
    """Numbers that are equal where the pieces are, and how many there are."""
    encoded = pieces.dictionary_encode()
    return encoded.indices.to_numpy().astype(np.int64), max(len(encoded.dictionary), 1)


def _numbered(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


def count_texts(texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The columns ``COUNTS`` for some texts, given with their bytes."""
    n = len(texts)

    def of_bytes(wanted: np.ndarray) -> np.ndarray:
        below = np.concatenate([[0], np.cumsum(wanted)])
        return below[offsets[1:]] - below[offsets[:-1]]

    owner, words = _pieces(pc.ascii_split_whitespace(texts))
    codes, kinds = _codes(words)
    again = np.zeros(len(codes), bool)
    if len(codes) > 3:
        inside = owner[:-2] == owner[2:]
        # Windows by number, a word at a time, then apart for each text.
        window = _numbered(codes[:-2] * kinds + codes[1:-1])
        window = _numbered(window * kinds + codes[2:])
        _, window, times = np.unique(window * n + owner[:-2], return_inverse=True, return_counts=True)
        # A window that reaches into the next text is counted for its first word's
        # text, so it must go before it is counted.
        if not inside.all():
            times = np.bincount(window[inside], minlength=len(times))
        found = inside & (times[window] > 1)
        for k in range(3):
            again[k : len(found) + k] |= found
    line_owner, lines = _pieces(pc.split_pattern(texts, "\n"))
    line_codes, _ = _codes(lines)
    n_lines = np.bincount(line_owner, minlength=n)
    distinct = np.unique(line_codes * n + line_owner) % n
    return [
        np.bincount(owner, minlength=n),
        of_bytes(_FIRST[data] & ~SPACE[data]),
        of_bytes(_SYMBOL[data]),
        n_lines - np.bincount(distinct, minlength=n),
        np.bincount(owner[again], minlength=n),
        n_lines,
    ]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").fill_null("")
        for row, end, data, offsets in chunks(texts):
            counts = count_texts(texts.slice(row, end - row), data, offsets)
            kept = batch.slice(row, end - row)
            yield pa.RecordBatch.from_arrays(
                [kept.column("doc_id"), kept.column("lang"), kept.column("source"), *(pa.array(c, pa.int64()) for c in counts)],
                ["doc_id", "lang", "source", *COUNTS],
            )


def text_counts(docs: DataFrame, id_column: str, text_column: str, groups: Sequence[str]) -> DataFrame:
    """(doc_id, lang, source, counts) of every row; the texts go no further."""
    prepare(docs.sparkSession)
    read = zip((id_column, text_column, *groups), ("doc_id", "text", "lang", "source"), strict=True)
    kinds = {"doc_id": "bigint"}
    rows = docs.select(*[F.col(f"`{c}`").cast(kinds.get(name, "string")).alias(name) for c, name in read])
    schema = "doc_id bigint, lang string, source string, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return rows.mapInArrow(returning(_counted), schema)


def bin_of(value: str) -> str:
    """The sketch's bin of an integer from 0 up, as SQL."""
    octave = f"(length(bin({value})) - {(2 * PER_OCTAVE - 1).bit_length()})"
    return f"CASE WHEN {value} < {2 * PER_OCTAVE} THEN {value} ELSE {PER_OCTAVE} * {octave} + shiftright({value}, {octave}) END"


def top_of(number: str) -> str:
    """The largest integer of a bin, as SQL."""
    octave = f"({number} div {PER_OCTAVE} - 1)"
    return (
        f"CASE WHEN {number} < {2 * PER_OCTAVE} THEN {number} ELSE "
        f"shiftleft({number} - {PER_OCTAVE} * {octave} + 1, cast({octave} AS int)) - 1 END"
    )


def sketches(judged: DataFrame) -> DataFrame:
    """(lang, source, level, measure, bin, n): a sketch per measure for each group (level
    0), each language (1) and the table (2), merged from the former."""
    pairs = ", ".join(f"'{m.name}', {m.name}" for m in MEASURES)
    values = judged.selectExpr("lang", "source", f"stack({len(MEASURES)}, {pairs}) AS (measure, value)")
    groups = values.selectExpr("lang", "source", "measure", f"{bin_of('value')} AS bin")
    groups = groups.groupBy("lang", "source", "measure", "bin").agg(F.count(F.lit(1)).alias("n"))
    groups = written(groups, "sketches")
    nothing = F.lit(None).cast("string")
    languages = groups.groupBy("lang", "measure", "bin").agg(F.sum("n").alias("n"))
    table = groups.groupBy("measure", "bin").agg(F.sum("n").alias("n"))
    return (
        groups.withColumn("level", F.lit(0))
        .unionByName(languages.withColumns({"source": nothing, "level": F.lit(1)}))
        .unionByName(table.withColumns({"lang": nothing, "source": nothing, "level": F.lit(2)}))
    )


def fences(sketched: DataFrame) -> DataFrame:
    """(lang, source, level, members and for each measure its upper and lower fence), a
    row for each sketched group."""
    of = ["level", "lang", "source", "measure"]
    order = Window.partitionBy(*of).orderBy("bin")
    ranks = sketched.select(
        *of, "bin", F.sum("n").over(order).alias("upto"), F.sum("n").over(Window.partitionBy(*of)).alias("members")
    )
    # The bin of the value at place ceil(q * members).
    quartiles = ranks.groupBy(*of, "members").agg(
        F.min(F.expr("CASE WHEN 4 * upto >= members THEN bin END")).alias("low"),
        F.min(F.expr("CASE WHEN 4 * upto >= 3 * members THEN bin END")).alias("high"),
    )
    values = quartiles.selectExpr(*of, "members", f"{top_of('low')} AS q1", f"{top_of('high')} AS q3")
    facts = []
    for m in MEASURES:
        mine, step = F.col("measure") == m.name, F.greatest(F.col("q3") - F.col("q1"), F.lit(m.spread)) * FENCE
        facts.append(F.max(F.when(mine, F.col("q3") + step)).alias(f"{m.name}_most"))
        if m.low:
            facts.append(F.max(F.when(mine, F.col("q1") - step)).alias(f"{m.name}_least"))
    return values.groupBy("level", "lang", "source").agg(F.max("members").alias("members"), *facts)


def _limits() -> list[str]:
    return [f"{m.name}_{side}" for m in MEASURES for side in (("most", "least") if m.low else ("most",))]


def fences_of_groups(judged: DataFrame, least_rows: int) -> DataFrame:
    """(of_lang, of_source, fence columns): those of the narrowest group with enough rows."""
    found = written(fences(sketches(judged)), "fences")

    def level(n: int, prefix: str) -> DataFrame:
        return found.where(F.col("level") == n).select(
            F.col("lang").alias(f"{prefix}_lang"), F.col("source").alias(f"{prefix}_source"),
            F.col("members").alias(f"{prefix}_members"), *[F.col(c).alias(f"{prefix}_{c}") for c in _limits()],
        )

    groups, languages = level(0, "of"), level(1, "wide")
    joined = groups.join(small_side(languages), F.col("of_lang").eqNullSafe(F.col("wide_lang")))
    table = found.where(F.col("level") == 2).first()  # one row, or none
    picked = [
        F.when(F.col("of_members") >= least_rows, F.col(f"of_{c}"))
        .when(F.col("wide_members") >= least_rows, F.col(f"wide_{c}"))
        .otherwise(F.lit(table[c] if table else None).cast("bigint"))
        .alias(c)
        for c in _limits()
    ]
    return joined.select("of_lang", "of_source", *picked)


def judge(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    groups: Sequence[str] = ("lang", "source"),
    least_rows: int = LEAST_ROWS,
) -> DataFrame:
    """Per row: doc_id, the counts, base_failed, kept, failed_rules (the names of the
    measures outside the fences, sorted)."""
    counts = written(text_counts(docs, id_column, text_column, groups), "counts")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = counts.withColumns({"base_failed": failed, **{m.name: m.value() for m in MEASURES}})
    limits = written(fences_of_groups(rows.where(~F.col("base_failed")), least_rows), "limits")
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    # A group all of whose rows failed the base rules has no fences, and needs none.
    judged = rows.join(small_side(limits), same, "left")
    broken = []
    for m in MEASURES:
        outside = F.col(m.name) > F.col(f"{m.name}_most")
        if m.low:
            outside = outside | (F.col(m.name) < F.col(f"{m.name}_least"))
        broken.append(F.when(~F.col("base_failed") & outside, F.lit(m.name)))
    return judged.select(
        "doc_id", *COUNTS, "base_failed", F.array_join(F.array_sort(F.array_compact(F.array(*broken))), ",").alias("failed_rules")
    ).withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))

