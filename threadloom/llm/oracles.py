"""DuckDB SQL for the queries that SQL can express, written by plain comparison and not by the operators' methods."""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAREST_VECTORS = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS s
  FROM w
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS node, doc_id AS found FROM documents
  UNION
  SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.found
), component AS (
  SELECT node, min(found) AS component_id FROM reach GROUP BY node
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN component ON node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

# The wording of the notices as patterns over words with single spaces between them.
NOTICES = (
    ("all-rights-reserved", " all rights reserved "),
    ("apache-2.0", " licensed under the apache license version 2 0 "),
    (
        "bsd-text",
        " redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
        "( 1)? redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"
        "( 2)? redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or"
        " other materials provided with the distribution( 3)?( neither the name of( [^ ]+){0,12} nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission)? this software is provided by( [^ ]+){0,10} as is and any express or implied"
        " warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall"
        "( [^ ]+){0,10} be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute"
        " goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort"
        " including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage ",
    ),
    ("cc-by-4.0", " licensed under( a)?( creative commons)? cc by 4 0 "),
    ("cc-by-nc-4.0", " licensed under( a)?( creative commons)? cc by nc 4 0 "),
    ("cc-by-sa-4.0", " licensed under( a)?( creative commons)? cc by sa 4 0 "),
    ("cc-notice", " licensed under a creative commons( [^ ]+){0,6} license "),
    ("gpl-2.0", " licensed under( the terms of)? the gnu general public license( as published by the free software foundation)?( either)? version 2 "),
    ("gpl-3.0", " licensed under( the terms of)? the gnu general public license( as published by the free software foundation)?( either)? version 3 "),
    ("gpl-notice", " you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation "),
    (
        "isc-text",
        " permission to use copy modify( [^ ]+){0,2} distribute this software for any purpose with or without fee is hereby granted provided that the above copyright"
        " notice and this permission notice appear in all copies the software is provided as is and( [^ ]+){0,6} disclaims all warranties with regard to this software"
        " including all implied warranties of merchantability and fitness in no event shall( [^ ]+){0,6} be liable for any special direct indirect or consequential damages"
        " or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in"
        " connection with the use or performance of this software ",
    ),
    ("lgpl-notice", " under the terms of the gnu (lesser|library) general public license( [^ ]+){0,6} as published by the free software foundation "),
    ("mit-notice", " (released|licensed) under the mit license "),
    (
        "mit-text",
        " permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files( the software)? to deal in the"
        " software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"
        " and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice"
        "( including the next paragraph)? shall be included in all copies or substantial portions of the software the software is provided as is without warranty of"
        " any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall"
        "( [^ ]+){0,8} be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the"
        " software or the use or other dealings in the software ",
    ),
    ("mpl-2.0", " subject to the terms of the mozilla public license v 2 0 "),
    ("unlicense", " this is free and unencumbered software released into the public domain "),
)

_ACCEPTED = ", ".join(f"CASE WHEN regexp_matches(line, '{pattern}') THEN '{label}' END" for label, pattern in NOTICES)


def _places(*phrase: str) -> str:
    here = " AND ".join(f"words[i + {n}] = '{word}'" for n, word in enumerate(phrase))
    return f"list_filter(range(1, len(words) + 1), lambda i: coalesce({here}, false))"


LICENSES = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), p AS (
  SELECT doc_id, len(words) AS n_words, ' ' || array_to_string(words, ' ') || ' ' AS line, {_places("mit", "license")} AS mit,
    {_places("apache", "license")} AS apache, {_places("general", "public", "license")} AS gpl
  FROM w
), s AS (
  SELECT *, list_sort(list_concat(list_concat(mit, apache), gpl)) AS starts,
    list_filter([CASE WHEN len(apache) > 0 THEN 'apache' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END,
      CASE WHEN len(mit) > 0 THEN 'mit' END], lambda x: x IS NOT NULL) AS base,
    list_filter([{_ACCEPTED}], lambda x: x IS NOT NULL) AS notices
  FROM p
)
SELECT doc_id, n_words, len(starts) AS n_base, starts[1] - 1 AS first_word, starts[len(starts)] - 1 AS last_word,
  array_to_string(base, ',') AS base_labels, array_to_string(list_sort(list_distinct(list_concat(base, notices))), ',') AS labels,
  CASE WHEN len(notices) > 0 THEN 1.0::DOUBLE WHEN len(starts) > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM s
"""

# Every line with a word. Two different lines of five words or more each are near when one inserted, deleted or replaced
# word makes them equal; such lines agree in the first or the last half of the shorter one, so pairs are formed on these only.
LINE_DEDUP = rf"""
WITH s AS MATERIALIZED (
  SELECT doc_id, string_split({LOWER}, chr(10)) AS parts FROM documents
), l AS MATERIALIZED (
  SELECT doc_id, unnest(range(len(parts))) AS line, regexp_extract_all(unnest(parts), '[^\x20\x09-\x0D]+') AS words FROM s
), d AS MATERIALIZED (
  SELECT words, len(words) AS n, min({{'id': doc_id, 'line': line}}) AS place FROM l WHERE len(words) >= 1 GROUP BY words
), halves AS (
  SELECT place, n, words, s, part, CASE part WHEN 0 THEN words[1:s // 2] ELSE words[n - (s - s // 2) + 1:n] END AS half
  FROM d, unnest([n, n - 1]) AS x(s), unnest([0, 1]) AS y(part) WHERE n >= 5
), pairs AS (
  SELECT DISTINCT a.place AS a, b.place AS b FROM halves a JOIN halves b ON a.s = b.s AND a.part = b.part AND a.half = b.half
  WHERE a.s = a.n AND b.n IN (a.n, a.n + 1) AND a.place <> b.place
), compared AS (
  SELECT p.a, p.b, x.n, y.n AS m, x.words AS v, y.words AS w,
    coalesce(list_position(list_transform(range(1, x.n + 1), lambda i: x.words[i] = y.words[i]), false), x.n + 1) AS first
  FROM pairs p JOIN d x ON x.place = p.a JOIN d y ON y.place = p.b
), near AS (
  SELECT a, b FROM compared WHERE CASE WHEN n = m THEN v[first + 1:n] = w[first + 1:m] ELSE v[first:n] = w[first + 1:m] END
), earliest AS (
  SELECT place, min(other) AS other FROM (SELECT a AS place, b AS other FROM near UNION ALL SELECT b, a FROM near) GROUP BY place
), firsts AS (
  SELECT d.words, least(d.place, coalesce(e.other, d.place)) AS first FROM d LEFT JOIN earliest e ON e.place = d.place
)
SELECT doc_id, line::INT AS line, first.id AS first_doc_id, first.line::INT AS first_line, doc_id = first.id AND line = first.line AS kept
FROM l JOIN firsts f ON f.words = l.words
"""


def _strength(level: str) -> str:
    """Strength of the prior of a level by moments, between 1 and 1000."""
    return f"""
  SELECT CASE WHEN rho > 0 THEN round(least(greatest(1 / rho - 1, 1.0::DOUBLE), 1000.0::DOUBLE), 6) ELSE 1000.0::DOUBLE END AS k
  FROM (SELECT CASE WHEN sum(m * (1 - m) * (n - 1)) > 0
    THEN (sum(n * (bad / n - m) * (bad / n - m)) - sum(m * (1 - m))) / sum(m * (1 - m) * (n - 1)) ELSE 0 END AS rho FROM {level})"""


def _posterior(level: str) -> str:
    return f"SELECT {level}, bad + k * m AS a, n - bad + k * (1 - m) AS b, (bad + k * m) / (n + k) AS mean FROM {level}_units, {level}_strength"


def _bound(a: str, b: str) -> str:
    return f"round({a} / ({a} + {b}) - 1.645::DOUBLE * sqrt({a} * {b} / (({a} + {b}) * ({a} + {b}) * ({a} + {b} + 1))), 9)"


# Public suffixes of two labels.
_TWO = "'ac.uk', 'co.jp', 'co.kr', 'co.nz', 'co.uk', 'co.za', 'com.ar', 'com.au', 'com.br', 'com.cn', 'com.mx', 'com.tr', 'gov.uk', 'net.au', 'org.au', 'org.uk'"

URL_FILTERS = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), p AS MATERIALIZED (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), named AS MATERIALIZED (
  SELECT DISTINCT host, array_to_string(string_split(host, '.')[-2:], '.') IN ({_TWO}) AS two, string_split(host, '.') AS parts FROM p
), h AS MATERIALIZED (
  SELECT host, array_to_string(CASE WHEN two THEN parts[-3:] ELSE parts[-2:] END, '.') AS domain,
    array_to_string(CASE WHEN two THEN parts[-2:] ELSE parts[-1:] END, '.') AS suffix FROM named
), outcomes AS (
  SELECT host, count(*) AS n, sum(1 - quality)::DOUBLE AS bad FROM p JOIN labels l ON l.doc_id = page_id WHERE quality IN (0, 1) AND host <> '' GROUP BY host
), o AS MATERIALIZED (
  SELECT * FROM outcomes JOIN h USING (host)
), overall AS (
  SELECT coalesce(sum(bad), 0) + 0.5::DOUBLE AS a, coalesce(sum(n - bad), 0) + 0.5::DOUBLE AS b FROM o
), suffix_units AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(a / (a + b)) AS m FROM o, overall GROUP BY suffix
), suffix_strength AS ({_strength("suffix_units")}
), suffix_known AS MATERIALIZED ({_posterior("suffix")}
), domain_units AS (
  SELECT domain, sum(n) AS n, sum(bad) AS bad, any_value(mean) AS m FROM o JOIN suffix_known USING (suffix) GROUP BY domain
), domain_strength AS ({_strength("domain_units")}
), domain_known AS MATERIALIZED ({_posterior("domain")}
), host_units AS (
  SELECT host, n, bad, mean AS m FROM o JOIN domain_known USING (domain)
), host_strength AS ({_strength("host_units")}
), host_known AS MATERIALIZED ({_posterior("host")}
), bounds AS (
  SELECT h.host, CASE WHEN h.host = '' THEN {_bound("w.a", "w.b")}
    ELSE coalesce({_bound("x.a", "x.b")}, {_bound("y.a", "y.b")}, {_bound("z.a", "z.b")}, {_bound("w.a", "w.b")}) END AS bound
  FROM h LEFT JOIN host_known x ON x.host = h.host LEFT JOIN domain_known y ON y.domain = h.domain
    LEFT JOIN suffix_known z ON z.suffix = h.suffix, overall w
), ruled AS (
  SELECT page_id, p.host, path, bound, CASE
    WHEN (p.host = 'www.example.com' OR p.host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (p.host = 'example.com' OR p.host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (p.host = 'net' OR p.host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (p.host = 'net' OR p.host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (p.host = 'com' OR p.host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM p JOIN bounds b ON b.host = p.host
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

# Statistics, in this order, of the outlier vector with their least standard deviations.
_LEAST = {"length": 0.06, "symbols": 0.5, "lines": 0.8, "repeats": 0.8, "capitals": 0.35}
_SAME = "{0}.lang IS NOT DISTINCT FROM {1}.lang AND {0}.source IS NOT DISTINCT FROM {1}.source"


def _outlier_steps() -> str:
    """The start at medians, three concentration steps and the last distances, one named table each."""
    names, p = list(_LEAST), len(_LEAST)
    medians = ", ".join(f"median({f}) AS c{i}" for i, f in enumerate(names))
    spreads = ", ".join(f"median(abs({f} - c{i})) * 1.4826::DOUBLE / 256 AS d{i}" for i, f in enumerate(names))
    start = ", ".join(
        [f"c{i} / 256 AS m{i}" for i in range(p)]
        + [f"sqrt(d{i} * d{i} + {v * v!r}::DOUBLE) AS l{i}{i}" for i, v in enumerate(_LEAST.values())]
        + [f"0.0::DOUBLE AS l{i}{j}" for i in range(p) for j in range(i)]
    )
    tables = [
        f"medians AS (SELECT lang, source, {medians} FROM good GROUP BY lang, source)",
        f"""spreads AS (SELECT g.lang, g.source, {", ".join(f"any_value(c{i}) AS c{i}" for i in range(p))}, {spreads}
  FROM good g JOIN medians c ON {_SAME.format("g", "c")} GROUP BY g.lang, g.source)""",
        f"fit0 AS MATERIALIZED (SELECT lang, source, {start} FROM spreads)",
    ]
    z = ", ".join(
        f"({f} / 256 - m{i}{''.join(f' - l{i}{k} * z{k}' for k in range(i))}) / l{i}{i} AS z{i}" for i, f in enumerate(names)
    )
    d2 = " + ".join(f"z{i} * z{i}" for i in range(p))
    distances = f"SELECT t.*, {z}, {d2} AS d2 FROM {{0}} t JOIN {{1}} e ON {_SAME.format('t', 'e')}"
    for step in range(3):
        sums = ", ".join(
            [f"sum({f})::DOUBLE AS s{i}" for i, f in enumerate(names)]
            + [f"sum({names[i]} * {names[j]})::DOUBLE AS p{i}{j}" for i in range(p) for j in range(i + 1)]
        )
        scatter = ", ".join(
            [f"s{i} / n / 256 AS m{i}" for i in range(p)]
            # 1.4120710601890512: scatter of all normal rows over that of the nearest three quarters, five statistics.
            + [
                f"(p{i}{j} / n / 65536 - m{i} * m{j}) * 1.4120710601890512::DOUBLE" + (f" + {v * v!r}::DOUBLE" if i == j else "") + f" AS k{i}{j}"
                for i, v in enumerate(_LEAST.values()) for j in range(i + 1)
            ]
        )
        factor = []
        for j, v in enumerate(_LEAST.values()):
            done = lambda i, j=j: "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
            factor.append(f"sqrt(greatest(k{j}{j}{done(j)}, {v * v / 4!r}::DOUBLE)) AS l{j}{j}")
            factor += [f"(k{i}{j}{done(i)}) / l{j}{j} AS l{i}{j}" for i in range(j + 1, p)]
        tables += [
            f"placed{step} AS MATERIALIZED (SELECT *, floor(ln(1 + d2) * 64) AS bin FROM ({distances.format('good', f'fit{step}')}))",
            f"""upto{step} AS (SELECT lang, source, bin, sum(k) OVER (PARTITION BY lang, source ORDER BY bin) AS upto, sum(k) OVER (PARTITION BY lang, source) AS whole
  FROM (SELECT lang, source, bin, count(*) AS k FROM placed{step} GROUP BY ALL))""",
            f"limit{step} AS (SELECT lang, source, min(bin) AS most FROM upto{step} WHERE upto >= 0.75 * whole GROUP BY lang, source)",
            f"""moments{step} AS (SELECT t.lang, t.source, count(*)::DOUBLE AS n, {sums}
  FROM placed{step} t JOIN limit{step} e ON {_SAME.format("t", "e")} WHERE bin <= most GROUP BY t.lang, t.source)""",
            f"fit{step + 1} AS MATERIALIZED (SELECT lang, source, {', '.join(f'm{i}' for i in range(p))}, {', '.join(factor)} FROM (SELECT *, {scatter} FROM moments{step}))",
        ]
    tables.append(f"judged AS ({distances.format('good', 'fit3')})")
    return ", ".join(tables)


QUALITY_RULES = rf"""
WITH w AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), places AS (
  SELECT r, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM w
), windows AS (
  SELECT r, i, word AS a, lead(word) OVER (PARTITION BY r ORDER BY i) AS b, lead(word, 2) OVER (PARTITION BY r ORDER BY i) AS c FROM places
), twice AS (
  SELECT r, i FROM windows WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1
), repeated AS (
  SELECT r, count(DISTINCT p) AS k FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), counted AS (
  SELECT w.r, doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols, length(t) - length(regexp_replace(t, '\p{{Lu}}+', '', 'g')) AS n_capitals,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(k, 0) AS n_repeat_words
  FROM w LEFT JOIN repeated USING (r)
), based AS MATERIALIZED (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    round(ln(1 + word_chars / greatest(n_words, 1)) * 256)::BIGINT AS length,
    round(ln(1 + 100 * n_symbols / greatest(n_words, 1)) * 256)::BIGINT AS symbols,
    round(ln(1 + 100 * n_dup_lines / greatest(n_lines, 1)) * 256)::BIGINT AS lines,
    round(ln(1 + 100 * n_repeat_words / greatest(n_words, 1)) * 256)::BIGINT AS repeats,
    round(ln(1 + 100 * n_capitals / greatest(word_chars, 1)) * 256)::BIGINT AS capitals
  FROM counted
), good AS MATERIALIZED (
  SELECT * FROM based WHERE NOT base_failed
), {_outlier_steps()}
SELECT b.doc_id, b.n_words, b.word_chars, b.n_symbols, b.n_dup_lines, b.n_repeat_words, b.base_failed,
  NOT b.base_failed AND coalesce(d2, 0) <= 45 AS kept
FROM based b LEFT JOIN judged j ON j.r = b.r
"""

HARD_NEGATIVES = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER near AS rank, s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
WINDOW near AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER near <= 5
"""


SQL = {
    "op1_nearest_vectors": NEAREST_VECTORS,
    "op2_line_dedup": LINE_DEDUP,
    "op3_url_filters": URL_FILTERS,
    "op6_quality_rules": QUALITY_RULES,
    "op8_license_scan": LICENSES,
    "op10_near_duplicates": NEAR_DUPLICATES,
    "op11_hard_negatives": HARD_NEGATIVES,
}
