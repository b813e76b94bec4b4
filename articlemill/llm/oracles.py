"""DuckDB SQL for the queries that SQL can express, written from their definitions."""

from __future__ import annotations

import re

from articlemill.llm.license_scan import NOTICES

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACE_WORDS = f"list_filter(regexp_split_to_array({LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
PLAIN_WORDS = f"list_filter(regexp_split_to_array(coalesce({LOWER}, ''), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

#: Labels of the license templates as expressions over words parted by single blanks.
LICENSES = [
    ("apache-2.0", " apache license v2 | apache license( version)? 2 0 | you may not use( this)?( [^ ]+){0,2} except in compliance with the( apache)? license "),
    ("gpl-2.0", " gnu general public license( as published by the free software foundation)?( either)?( version)?( v)? 2 | gnu general public license( version)? v2 "),
    ("gpl-3.0", " gnu general public license( as published by the free software foundation)?( either)?( version)?( v)? 3 | gnu general public license( version)? v3 "),
    ("gpl-or-later", " gnu general public license( [^ ]+){0,12} or( at your option)? any later version "),
    ("cc-by-4.0", " cc by 4 0 "),
    ("cc-by-nc-4.0", " cc by nc 4 0 "),
    ("cc-by-sa-4.0", " cc by sa 4 0 "),
    ("mit-reference", " released under the mit license "),
    ("mit-grant", " permission is hereby granted free of charge to any person obtaining a copy of"
     "( this software and associated documentation files)?( [^ ]+){0,4} to deal in( [^ ]+){0,3} without restriction "),
    ("bsd", " redistribution and use in source and binary forms with or without modification( are permitted)? provided that the following conditions are met "),
    ("isc", " permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted "),
    ("all-rights-reserved", " copyright c( [^ ]+){0,8} all rights reserved "),
]


def expression(markup: str) -> str:
    """A template's markup as an expression over words parted by single blanks."""
    for mark, rx in (("<<opt>>", " ( "), ("<</opt>>", " )? "), (r"<<var;max=(\d+)>>", r" ( [^ ]+){0,\1} ")):
        markup = re.sub(mark, rx, markup)
    parts = [p if p[0] in "()[" or p.startswith(("]", "+")) else " " + p for p in re.sub(r"\( \[\^ \]\+\)", "(@)", markup).split()]
    return "".join(parts).replace("(@)", "( [^ ]+)") + " "


def op1() -> str:
    """A line goes if an equal one, or one that a single edit away, stands earlier. One edit leaves one half as it was."""
    one_edit = """len(list_filter(range(1, y.n + 1), lambda i: left(x.line, i - 1) = left(y.line, i - 1)
        AND substr(x.line, i + 1 - (y.n - x.n)) = substr(y.line, i + 1))) > 0"""
    return f"""WITH l AS MATERIALIZED (SELECT doc_id, p, arr[p + 1] AS line FROM
            (SELECT doc_id, string_split(text, chr(10)) AS arr FROM documents), unnest(range(0, len(arr))) AS t(p)),
        c AS MATERIALIZED (SELECT line, length(line) AS n, min((doc_id, p)) AS first FROM l WHERE length(line) >= 16 GROUP BY line),
        near AS MATERIALIZED (SELECT x.line AS a, x.first AS fa, y.line AS b, y.first AS fb
            FROM (SELECT *, unnest([n, n + 1]) AS m FROM c) AS x JOIN c AS y ON y.n = x.m
            WHERE x.line <> y.line AND (left(x.line, y.n // 2) = left(y.line, y.n // 2)
              OR right(x.line, y.n - y.n // 2) = right(y.line, y.n - y.n // 2)) AND {one_edit}),
        gone AS (SELECT a AS line FROM near WHERE fb < fa UNION SELECT b FROM near WHERE fa < fb),
        kept AS (SELECT doc_id, p FROM l WHERE length(line) < 16
            UNION SELECT first[1], first[2] FROM c WHERE line NOT IN (SELECT line FROM gone)),
        k AS (SELECT doc_id, count(*) AS n, string_agg(p::VARCHAR, ',' ORDER BY p) AS ps FROM kept GROUP BY doc_id)
        SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0) AS n_lines, coalesce(n, 0) AS n_kept,
            sha256(coalesce(ps, '')) AS kept_sha256 FROM documents LEFT JOIN k USING (doc_id)"""


def op6() -> str:
    phrases = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
    places = ", ".join(
        f"list_filter(range(1, len(w) + 1), lambda i: w[i : i + {len(p.split()) - 1}] = {p.split()!r}) AS p{k}" for k, (p, _) in enumerate(phrases)
    )
    base = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, (_, label) in enumerate(phrases))
    more = ", ".join(f"CASE WHEN regexp_matches(joined, '{rx}') THEN '{label}' END" for label, rx in [*LICENSES, *((name, expression(text)) for name, text in NOTICES)])
    return f"""WITH a AS (SELECT doc_id, {PLAIN_WORDS} AS w FROM documents),
        b AS (SELECT doc_id, len(w) AS n_words, ' ' || array_to_string(w, ' ') || ' ' AS joined, {places} FROM a),
        c AS (SELECT doc_id, n_words, p0 || p1 || p2 || p3 AS p,
          list_filter([{base}], lambda x: x IS NOT NULL) AS bases, list_filter([{more}], lambda x: x IS NOT NULL) AS mores FROM b)
        SELECT doc_id, n_words, len(p) AS n_base, list_min(p) - 1 AS first_word, list_max(p) - 1 AS last_word,
          array_to_string(list_sort(bases), ',') AS base_labels,
          array_to_string(list_sort(list_distinct(bases || mores)), ',') AS labels,
          CASE WHEN len(mores) > 0 THEN 1.0::DOUBLE WHEN len(p) > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score FROM c"""


def op7() -> str:
    return f"""WITH i AS (SELECT item_id, {PLAIN_WORDS} AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
            array_to_string(w[s : s + 9], ' ') AS words FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(s) WHERE len(w) > 0),
        d AS (SELECT doc_id, {PLAIN_WORDS} AS w FROM documents),
        placed AS (SELECT doc_id, s, k.n, array_to_string(w[s : s + k.n - 1], ' ') AS words
            FROM d, (SELECT DISTINCT n FROM win) AS k, unnest(range(1, len(w) - k.n + 2)) AS t(s)),
        hit AS (SELECT doc_id, s, placed.n, item_id FROM placed JOIN win USING (n, words)),
        words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + n)) AS t(p) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) AS x GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


def op10() -> str:
    return f"""WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {SPACE_WORDS} AS w FROM documents),
        s AS MATERIALIZED (SELECT DISTINCT doc_id, w[i : i + 1] AS g
            FROM d, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS t(i) WHERE len(w) > 0),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s AS x JOIN s AS y USING (g)
            WHERE x.doc_id <> y.doc_id GROUP BY ALL),
        links AS MATERIALIZED (SELECT a, b FROM pairs JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
            WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(b) AS component_id, d.doc_id = min(b) AS kept
        FROM d JOIN reach ON a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id"""


def op12(count: int = 40, rounds: int = 5, width: int = 64) -> str:
    """Distances as sums of squares, anew in each round; a mean is a floor in whole numbers."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT rid, any_value(vec_id) AS vec_id, any_value(x) AS x, min(far * {count} + k) AS best
            FROM (SELECT v.*, k, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS far
                FROM kept AS v, c{r}) AS f GROUP BY rid)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT best % {count} AS k, j, sum(x[j])::HUGEINT AS s, count(*)::HUGEINT AS n
                FROM a{r}, unnest(range(1, {width + 1})) AS t(j) GROUP BY ALL),
            c{r + 1} AS MATERIALIZED (SELECT k, coalesce(any_value(y), any_value(c)) AS c FROM c{r} LEFT JOIN
                (SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS y FROM m{r} GROUP BY k) AS z USING (k) GROUP BY k)""")
    return f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
            list_transform(embedding, lambda v: floor(256 * v::DOUBLE)::BIGINT) AS x
            FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda v: isfinite(v))) = {width}),
        c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, c) - 1 AS k, c
            FROM (SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, x AS c FROM kept ORDER BY h, c LIMIT {count}) AS f),
        {", ".join(steps)},
        placed AS (SELECT vec_id, (best % {count})::INTEGER AS cluster, (best // {count})::BIGINT AS distance FROM a{rounds})
        SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
            sha256(array_to_string(c, ',')) AS centroid_sha256 FROM placed JOIN c{rounds} ON k = cluster"""


def oracles() -> dict[str, str]:
    return {"op1_line_dedup": op1(), "op6_license_scan": op6(), "op7_decontamination": op7(), "op10_minhash": op10(), "op12_centroid_clustering": op12()}
