"""DuckDB SQL for the queries whose SQL is long: rounds and levels written out by loops."""

from __future__ import annotations


def centroids_sql(clusters: int = 8, rounds: int = 10, size: int = 64) -> str:
    """Integer k-means. Each round is a pair of tables: rows with their cluster, then centroids."""
    square = "list_sum(list_transform(range(1, {n}), lambda i: (v[i] - c[i]) * (v[i] - c[i])))".format(n=size + 1)
    floor = "(s - ((s % n) + n) % n) // n"
    parts = [
        f"""kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}
        )""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k, v AS c
            FROM kept QUALIFY k < {clusters}
        )""",
    ]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
            SELECT vec_id, v, k, CAST({square} AS BIGINT) AS d FROM kept, c{r}
            QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1
        )""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
                SELECT k, coalesce(after, c) AS c FROM c{r} LEFT JOIN (
                    SELECT k, list(CAST({floor} AS BIGINT) ORDER BY i) AS after
                    FROM (
                        SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
                        FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY k, i
                    ) GROUP BY k
                ) USING (k)
            )""")
    return f"""
        WITH {", ".join(parts)}
        SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance,
               CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
               CAST(sum(d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c, ',')) AS centroid_sha256,
               count(*) OVER (PARTITION BY k) AS cluster_size
        FROM a{rounds} JOIN c{rounds} USING (k)
    """


def _level_sql(name: str, below: str, group: str, carried: str) -> str:
    """The level above table ``below`` (group, r, h): runs of three become one node, trees
    of one node stay as they are."""
    return f"""{name} AS MATERIALIZED (
        SELECT {group}, r // 3 AS r, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY r)) ELSE min(h) END AS h
        FROM (SELECT *, count(*) OVER (PARTITION BY {group}) AS n FROM {below}) GROUP BY {group}, r // 3
    ), {carried} AS MATERIALIZED (
        SELECT {group}, r,
               CASE WHEN n > 1 THEN coalesce(string_agg(h, '' ORDER BY r) OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS lhs,
               CASE WHEN n > 1 THEN coalesce(string_agg(h, '' ORDER BY r) OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS rhs,
               n > 1 AS real
        FROM (SELECT *, count(*) OVER (PARTITION BY {group}) AS n FROM {below})
        WINDOW run AS (PARTITION BY {group}, r // 3 ORDER BY r)
    )"""


def merkle_sql(levels: int = 12, top_levels: int = 6) -> str:
    """Trees of up to 3**levels rows a source and 3**top_levels sources, level by level."""

    def field(value: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}) || ':' || {value} END"

    def leaf(text: str) -> str:
        values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return f"sha256({' || '.join(field(v) for v in values)})"

    # Bits of the checksum, byte by byte: its decimal digits are 48 and more.
    checksum = (
        "xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
        "lambda d: list_concat([CAST(ascii(d) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1])))), "
        "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"
    )
    parts = [
        f"""d AS (
            SELECT doc_id, source, {leaf('text')} AS leaf,
                   {leaf("CASE WHEN " + checksum + " % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS shown
            FROM documents
        )""",
        """ranked AS MATERIALIZED (
            SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM d
        )""",
        "n0 AS (SELECT t, r, leaf AS h FROM ranked)",
    ]
    parts += [_level_sql(f"n{k + 1}", f"n{k}", "t", f"s{k}") for k in range(levels)]
    parts.append(f"u0 AS (SELECT 0 AS g, t AS r, h FROM n{levels})")
    parts += [_level_sql(f"u{k + 1}", f"u{k}", "g", f"v{k}") for k in range(top_levels)]
    parts.append("f0 AS (SELECT doc_id, leaf, t, r, t AS top, shown AS f, '' AS proof FROM ranked)")
    step = """{after} AS MATERIALIZED (
        SELECT doc_id, leaf, {before}.t, {r}, {top}, CASE WHEN real THEN sha256(lhs || f || rhs) ELSE f END AS f,
               proof || lhs || rhs AS proof
        FROM {before} JOIN {sides} ON {on}
    )"""
    for k in range(levels):
        parts.append(step.format(after=f"f{k + 1}", before=f"f{k}", sides=f"s{k}", r=f"f{k}.r // 3 AS r", top="top", on=f"s{k}.t = f{k}.t AND s{k}.r = f{k}.r"))
    for k in range(levels, levels + top_levels):
        parts.append(step.format(after=f"f{k + 1}", before=f"f{k}", sides=f"v{k - levels}", r=f"f{k}.r", top="top // 3 AS top", on=f"v{k - levels}.r = top"))
    last = f"f{levels + top_levels}"
    return f"""
        WITH {", ".join(parts)}
        SELECT doc_id, leaf, n{levels}.h AS subroot, u{top_levels}.h AS root, sha256(proof) AS proof_sha256,
               f AS folded_root, strlen(proof) // 64 AS n_siblings, f = u{top_levels}.h AS verified
        FROM {last} JOIN n{levels} ON n{levels}.t = {last}.t, u{top_levels}
    """


def quality_rules_sql() -> str:
    """Counts, sketches by log-linear bins, fences of the narrowest group of 200 rows, verdicts."""
    measures = {
        "symbols": ("1000 * n_symbols // greatest(word_chars, 1)", 15),
        "repeated_lines": ("1000 * n_dup_lines // greatest(n_lines, 1)", 50),
        "repeated_words": ("1000 * n_repeat_words // greatest(n_words, 1)", 50),
        "word_length": ("100 * word_chars // greatest(n_words, 1)", 30),
    }
    values = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS measure, {m} AS v FROM rows WHERE NOT base_failed" for m in measures
    )
    levels = ["lang, source", "lang, NULL AS source", "NULL AS lang, NULL AS source"]
    binned = " UNION ALL ".join(
        f"""SELECT {n} AS level, {group}, measure, bin, count(*) AS n FROM (
            SELECT *, CASE WHEN v < 64 THEN v ELSE 32 * (length(bin(v)) - 6) + (v >> CAST(length(bin(v)) - 6 AS BIGINT)) END AS bin FROM values_
        ) GROUP BY ALL"""
        for n, group in enumerate(levels)
    )
    top = "CASE WHEN {b} < 64 THEN {b} ELSE (({b} - 32 * ({b} // 32 - 1) + 1) << ({b} // 32 - 1)) - 1 END"
    spread = "CASE measure " + " ".join(f"WHEN '{m}' THEN {s}" for m, (_, s) in measures.items()) + " END"
    rules = ", ".join(
        f"""CASE WHEN NOT base_failed AND ({m} > f_{m}.most{f" OR {m} < f_{m}.least" if m == "word_length" else ""}) THEN '{m}' END"""
        for m in measures
    )
    joins = " ".join(
        f"LEFT JOIN picked f_{m} ON f_{m}.measure = '{m}' AND f_{m}.lang IS NOT DISTINCT FROM rows.lang AND f_{m}.source IS NOT DISTINCT FROM rows.source"
        for m in measures
    )
    return f"""
        WITH d AS (
            SELECT doc_id, lang, source, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
            FROM documents
        ), windows AS (
            SELECT doc_id, p, words[p:p + 2] AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS p FROM d)
        ), repeated AS (
            SELECT doc_id, count(DISTINCT p + k) AS n FROM (
                SELECT doc_id, p FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
            ), (SELECT unnest(range(0, 3)) AS k) GROUP BY doc_id
        ), lines AS (
            SELECT doc_id, count(*) AS n, count(DISTINCT line) AS kinds
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
            WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
        ), counts AS (
            SELECT doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
                   len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
                   coalesce(lines.n - kinds, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
                   coalesce(lines.n, 0) AS n_lines
            FROM d LEFT JOIN repeated USING (doc_id) LEFT JOIN lines USING (doc_id)
        ), rows AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                   {", ".join(f"{v} AS {m}" for m, (v, _) in measures.items())}
            FROM counts
        ), values_ AS ({values}), sketches AS ({binned}), ranks AS (
            SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bin) AS upto,
                   sum(n) OVER (PARTITION BY level, lang, source, measure) AS members FROM sketches
        ), quartiles AS (
            SELECT level, lang, source, measure, members, min(bin) FILTER (4 * upto >= members) AS a,
                   min(bin) FILTER (4 * upto >= 3 * members) AS b
            FROM ranks GROUP BY ALL
        ), fences AS (
            SELECT level, lang, source, measure, members, {top.format(b="a")} AS q1, {top.format(b="b")} AS q3,
                   q3 + 3 * greatest(q3 - q1, {spread}) AS most, q1 - 3 * greatest(q3 - q1, {spread}) AS least
            FROM quartiles
        ), picked AS (
            SELECT g.lang, g.source, g.measure,
                   CASE WHEN g.members >= 200 THEN g.most WHEN l.members >= 200 THEN l.most ELSE t.most END AS most,
                   CASE WHEN g.members >= 200 THEN g.least WHEN l.members >= 200 THEN l.least ELSE t.least END AS least
            FROM fences g JOIN fences l ON l.level = 1 AND l.lang IS NOT DISTINCT FROM g.lang AND l.measure = g.measure
            JOIN fences t ON t.level = 2 AND t.measure = g.measure WHERE g.level = 0
        ), verdicts AS (
            SELECT rows.*, list_filter([{rules}], lambda x: x IS NOT NULL) AS broken FROM rows {joins}
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
               array_to_string(list_sort(broken), ',') AS failed_rules, NOT base_failed AND len(broken) = 0 AS kept
        FROM verdicts
    """


def ngram_jaccard_sql() -> str:
    """Sets of 5-word shingles, all pairs that share one, and what their links reach."""
    return """
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x20\\x09-\\x0D]+'
            ) AS words FROM documents
        ), shingles AS MATERIALIZED (
            SELECT DISTINCT doc_id, words[p:p + 4] AS gram
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) AS p FROM d)
        ), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS MATERIALIZED (
            SELECT a, b FROM (
                SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
                FROM shingles x JOIN shingles y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL
            ) JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b
            WHERE 100 * shared >= 75 * (m.n + n.n - shared)
        ), reached AS (
            SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
        )
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM d LEFT JOIN sizes USING (doc_id)
        JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) USING (doc_id)
    """
