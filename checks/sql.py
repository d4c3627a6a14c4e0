"""Building blocks of the SQL counterparts: the adapters' views and the longer shared steps."""

from __future__ import annotations

from checks import adapters as A
from threadloom.functions.lexicon import NEGATION_FACTOR
from threadloom.functions.text import SENTIMENT_BANDS, STOP_WORDS

SP = r"\s\p{Z}"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def r6(x: str) -> str:
    return f"(round(({x}) + 1e-9, 6) + 0.0)"


def values(rows: list[tuple], columns: str) -> str:
    def cell(v) -> str:
        return "NULL" if v is None else q(v) if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({columns}))"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


BANDS = "[" + ", ".join(map(q, SENTIMENT_BANDS)) + "]"

TEXT_RECORDS = f"""
text_records AS (
  SELECT d.doc_id, CAST(d.doc_id AS VARCHAR) AS id, substring(d.text, 1, 80) AS title, d.text,
    'http://example.com/' || d.doc_id AS url,
    CASE WHEN e.event_type <> 'error' THEN 'u' || e.user_id END AS author,
    CAST(floor(e.value) AS INTEGER) AS score, CAST(d.n_chars AS INTEGER) AS num_comments,
    date_trunc('second', e.ts) AS created_date, CAST(floor(epoch(e.ts)) AS BIGINT) AS created_utc,
    d.source AS subreddit, CAST(substring(d.source, 4) AS INTEGER) AS subreddit_id,
    CASE WHEN e.event_type = 'click' THEN '' ELSE '/c/' || d.doc_id END AS permalink,
    e.event_type, d.lang
  FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id * 5)"""

TEXT_SUBREDDITS = """
subreddits AS (SELECT DISTINCT CAST(substring(source, 4) AS INTEGER) AS subreddit_id, source AS name FROM documents)"""

COMMENT_RECORDS = """
comment_records AS (
  SELECT conv_id || '_' || turn AS id, CASE WHEN role <> 'system' THEN CAST(conv_id AS VARCHAR) ELSE '' END AS post_id,
    CASE WHEN turn = 0 THEN 't3_' || conv_id ELSE conv_id || '_' || (turn - 1) END AS parent_id,
    text AS body, role AS author, CAST(turn AS INTEGER) AS score,
    TIMESTAMP '1970-01-01' + to_seconds(CAST(conv_id * 60 + turn AS BIGINT)) AS created_date, conv_id, turn
  FROM conversations)"""

TRADE = """
subreddits AS (SELECT CAST(n_nationkey + 1 AS INTEGER) AS subreddit_id, n_name AS name FROM nation),
posts AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS post_id, CAST(c.c_nationkey + 1 AS INTEGER) AS subreddit_id,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN 'HIRING: urgent job' WHEN '2-HIGH' THEN 'Looking for a career?'
      WHEN '3-MEDIUM' THEN 'Weekly question?' ELSE o.o_orderpriority END AS title,
    repeat(o.o_orderstatus || ' ' || o.o_orderpriority || ' ', CAST(1 + floor(o.o_totalprice / 20000) AS INTEGER)) AS text,
    CASE WHEN c.c_acctbal < 0 THEN '[deleted]' ELSE 'u' || o.o_custkey END AS author,
    CAST(floor(o.o_totalprice) AS INTEGER) AS score,
    CASE WHEN o.o_orderstatus = 'P' THEN '' ELSE '/comments/' || o.o_orderkey END AS permalink,
    o.o_orderdate AS created_date,
    (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS num_comments
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey),
analysis AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS post_id, a.tech_mentioned, a.skills_mentioned, a.sentiment_score,
    o.o_orderdate AS processed_date
  FROM orders o LEFT JOIN (
    SELECT l.l_orderkey, list_sort(list(DISTINCT p.p_brand)) AS tech_mentioned,
      list_sort(list(DISTINCT p.p_type)) AS skills_mentioned,
      CAST(sum(CAST(round(l.l_discount * 100) AS BIGINT)) AS DOUBLE) / (5.0::DOUBLE * count(*)) - 1.0::DOUBLE AS sentiment_score
    FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1) a ON a.l_orderkey = o.o_orderkey),
comments AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS comment_id,
    CAST(l_orderkey AS VARCHAR) AS post_id, 'u' || l_suppkey AS author, CAST(l_quantity AS INTEGER) AS score,
    l_shipdate AS created_date
  FROM lineitem),
mentions AS (
  SELECT unnest(a.tech_mentioned) AS tech_name, p.post_id, p.subreddit_id, p.score, p.num_comments, p.created_date,
    CAST(date_trunc('week', p.created_date) AS DATE) AS week_start,
    CAST(date_trunc('month', p.created_date) AS DATE) AS month_start, a.sentiment_score, a.processed_date
  FROM analysis a JOIN posts p USING (post_id)),
trends AS (
  SELECT tech_name, week_start, subreddit_id, count(*) AS mention_count, avg(sentiment_score) AS sentiment_avg
  FROM mentions GROUP BY 1, 2, 3)"""

POPULAR = """
popular AS (SELECT tech_name, sum(mention_count) AS total_mentions FROM trends GROUP BY 1 HAVING sum(mention_count) >= 3),
pairs AS (
  SELECT a.tech_name AS tech_name_1, b.tech_name AS tech_name_2, count(*) AS together
  FROM mentions a JOIN mentions b ON a.post_id = b.post_id AND a.tech_name < b.tech_name
  WHERE a.tech_name IN (SELECT tech_name FROM popular) AND b.tech_name IN (SELECT tech_name FROM popular)
  GROUP BY 1, 2),
scores AS (
  SELECT tech_name_1, tech_name_2,
    CAST(together AS DOUBLE) / (x.total_mentions + y.total_mentions - together) AS correlation_score
  FROM pairs JOIN popular x ON x.tech_name = tech_name_1 JOIN popular y ON y.tech_name = tech_name_2),
edges AS (SELECT * FROM scores WHERE correlation_score > 0.05)"""


def markup_free(x: str) -> str:
    """Lower-cased text reduced to letters and white space."""
    x = f"regexp_replace(lower({x}), '(?-s)<.*?>', '', 'g')"
    x = f"regexp_replace({x}, 'http[^{SP}]+|www[^{SP}]+', '', 'g')"
    return f"regexp_replace({x}, '[^a-zA-Z{SP}]', ' ', 'g')"


def tokens(x: str) -> str:
    stop = "[" + ", ".join(map(q, [*STOP_WORDS, "cannot"])) + "]"
    words = f"string_split_regex({markup_free(x)}, '[{SP}]+')"
    kept = f"list_filter({words}, lambda w: length(w) > 2 AND NOT list_contains({stop}, w))"
    short = " ".join(
        f"WHEN '{w}' THEN '{p}'"
        for w, p in {"gimme": "gim", "gonna": "gon", "gotta": "got", "lemme": "lem", "wanna": "wan"}.items()
    )
    return f"list_transform({kept}, lambda w: CASE w {short} ELSE w END)"


def grams(t: str, n: int) -> str:
    parts = " || ' ' || ".join(f"{t}[i + {k}]" if k else f"{t}[i]" for k in range(n))
    return f"list_transform(range(1, greatest(len({t}) - {n - 2}, 1)), lambda i: {parts})"


def top_counted(source: str, key: str, items: str, k: int = 10) -> str:
    """(key, top): the k most frequent items of a list column, joined, ties to the earlier one."""
    return f"""
    SELECT {key}, string_agg(item, '|' ORDER BY place) AS top FROM (
      SELECT {key}, item, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, first_at) AS place FROM (
        SELECT {key}, item, count(*) AS n, min(pl) AS first_at FROM (
          SELECT {key}, unnest({items}) AS item, unnest(range(1, len({items}) + 1)) AS pl FROM {source})
        GROUP BY 1, 2))
    WHERE place <= {k} GROUP BY 1"""


TERM_PAIRS = [
    (t.lower(), name.lower()) for items in A.TEXT_TERMS.values() for name, al, _ in items for t in [name, *al]
]
SKILL_PAIRS = [(t, name) for items in A.TEXT_SKILLS.values() for name, al, _ in items for t in [name, *al]]


def mentions_of(low: str, pairs: list[tuple[str, str]]) -> str:
    hits = ", ".join(f"CASE WHEN contains({low}, {q(t)}) THEN {q(n)} END" for t, n in pairs)
    return f"list_sort(list_distinct(list_filter([{hits}], lambda h: h IS NOT NULL)))"


def clean(x: str, words: list[str]) -> str:
    x = f"regexp_replace({x}, '(?s)```.*?```', ' CODE_BLOCK ', 'g')"
    x = f"regexp_replace({x}, '(?-s)`.*?`', ' CODE_SNIPPET ', 'g')"
    x = f"regexp_replace({x}, 'http[^{SP}]+|www[^{SP}]+', ' URL ', 'g')"
    x = f"regexp_replace({x}, '(?-s)<.*?>', '', 'g')"
    pattern = "|".join(sorted(set(words), key=lambda w: (-len(w), w)))
    x = f"regexp_replace({x}, '(?i)({pattern})', ' \\1 ', 'g')"
    x = f"regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_{SP}!?.,;:()]', ' ', 'g')"
    x = f"regexp_replace({x}, ':\\)', ' positive_emoji ', 'g')"
    x = f"regexp_replace({x}, ':\\(', ' negative_emoji ', 'g')"
    return f"trim(regexp_replace({x}, '[{SP}]+', ' ', 'g'), ' ')"


WORDS = [t for t, _ in TERM_PAIRS]


def scoring_rows(valences: dict[str, float]) -> str:
    names = sorted({*valences, *A.TEXT_BOOSTERS, *A.TEXT_NEGATIONS, *A.TEXT_POLARITIES})
    rows = [
        (
            t,
            valences.get(t),
            A.TEXT_BOOSTERS.get(t),
            "y" if t in A.TEXT_NEGATIONS else None,
            *(A.TEXT_POLARITIES.get(t) or (None, None)),
        )
        for t in names
    ]
    inner = values(rows, "term, v, b, n, p, s")
    return f"""SELECT term, CAST(v AS DOUBLE) AS v, CAST(b AS DOUBLE) AS b, n = 'y' AS n,
        CAST(p AS DOUBLE) AS p, CAST(s AS DOUBLE) AS s FROM {inner}"""


def phrased(idioms: dict[str, float], boosters: dict[str, float]) -> str:
    """Score s3 after the phrases around the word w: w1 to w3 stand before it, f1 and f2 after it. A phrase's own score
    counts, or else what it adds, where three words stand before and the farthest has no valence."""

    def run(*words: str) -> str:
        return " || ' ' || ".join(f"lower({w})" for w in words)

    def of(values: dict[str, float], text: str) -> str:
        return f"CASE {text} " + " ".join(f"WHEN {q(p)} THEN CAST({v} AS DOUBLE)" for p, v in values.items()) + " END"

    spots = [("w", "f1", "f2"), ("w", "f1"), ("w1", "w"), ("w2", "w1", "w"), ("w2", "w1"), ("w3", "w2", "w1"), ("w3", "w2")]
    own = ", ".join(of(idioms, run(*s)) for s in spots)
    added = " + ".join(f"coalesce({of(boosters, run(*s))}, CAST(0.0 AS DOUBLE))" for s in (spots[5], spots[6], spots[4]))
    return f"CASE WHEN pl > 3 AND v3 IS NULL THEN coalesce({own}, s3) + {added} ELSE s3 END"


MEAN_RATED = """rated AS (SELECT key, CAST(sum(CAST(p * 10 AS BIGINT)) AS DOUBLE) / 10 / count(p) AS polarity,
    CAST(sum(CAST(s * 10 AS BIGINT)) AS DOUBLE) / 10 / count(p) AS subjectivity FROM found WHERE p IS NOT NULL GROUP BY 1)"""


def assessed(intensities: dict[str, float]) -> str:
    """CTEs ending in `rated`: means over the known words with the modifiers, negations and marks around them."""
    marks, order = "[!?.,;:()_]+", "OVER (PARTITION BY key ORDER BY raw)"
    bangs = lambda x: f"(length({x}) - length(replace({x}, '!', '')))"
    one = lambda x: f"greatest(CAST(-1 AS DOUBLE), least(CAST(1 AS DOUBLE), {x}))"
    factor = "CASE lw " + " ".join(f"WHEN {q(t)} THEN CAST({v} AS DOUBLE)" for t, v in intensities.items()) + " END"
    return f"""r_tokens AS (SELECT *, regexp_replace(tok, '^{marks}', '') AS ahead, regexp_replace(regexp_replace(tok, '^{marks}', ''), '{marks}$', '') AS bare
  FROM (SELECT key, unnest(string_split(c, ' ')) AS tok, unnest(range(1, len(string_split(c, ' ')) + 1)) AS raw FROM cleaned)),
r_marked AS (SELECT key, raw, lower(bare) AS lw, {bangs("ahead")} - {bangs("bare")} AS behind, {bangs("tok")} - {bangs("bare")} AS around,
    sum({bangs("tok")} - {bangs("bare")}) {order} AS upto, sum({bangs("tok")} - {bangs("bare")}) OVER (PARTITION BY key) AS every FROM r_tokens),
r_words AS (SELECT m.*, g.p, g.s, CASE WHEN g.p IS NOT NULL THEN {factor} END AS f, g.p IS NOT NULL AS known,
    lw IN ('no', 'not', 'never') AS negates, length(lw) > 2 AS far FROM r_marked m LEFT JOIN scoring g ON g.term = lw WHERE length(lw) > 1),
r_counted AS (SELECT *, count(*) FILTER (far AND NOT known AND NOT negates) {order} AS n_ended, count(*) FILTER (far AND NOT known) {order} AS n_far,
    count(*) FILTER (negates AND NOT known) {order} AS n_neg, lag(negates) {order} AS neg_before, lag(known) {order} AS known_before FROM r_words),
r_reach AS (SELECT *, coalesce(min(n_neg) FILTER (known OR (far AND NOT negates))
      OVER (PARTITION BY key ORDER BY raw ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), max(n_neg) OVER (PARTITION BY key)) AS neg_beyond FROM r_counted),
r_known AS (SELECT *, lag(f IS NOT NULL) {order} AS led, lag(f IS NOT NULL AND lw LIKE '%ly') {order} AS adverb, lag(n_ended) {order} AS last_ended,
    lag(n_far) {order} AS last_far, lead(upto - behind) {order} AS next_upto FROM r_reach WHERE known),
r_linked AS (SELECT *, coalesce(led AND CASE WHEN adverb THEN n_ended = last_ended ELSE n_far = last_far END, false) AS merged,
    coalesce(neg_before, false) AND NOT coalesce(adverb AND n_ended = last_ended AND NOT known_before, false) AS negated,
    f IS NOT NULL AND lw LIKE '%ly' AND neg_beyond > n_neg AS own_negation, coalesce(next_upto, every) - upto + behind AS n_marks FROM r_known),
r_factors AS (SELECT *, CASE WHEN negated THEN coalesce(1 / nullif(coalesce(f, 1), 0), 0) ELSE coalesce(f, 1) END AS own FROM r_linked),
r_timed AS (SELECT *, lag(own) {order} AS times, sum(CASE WHEN merged THEN 0 ELSE 1 END) {order} AS grp, coalesce(lead(merged) {order}, false) AS goes_on FROM r_factors),
r_values AS (SELECT *, CASE WHEN merged THEN {one("p * times")} ELSE p END AS p1, CASE WHEN merged THEN {one("s * times")} ELSE s END AS s1,
    bool_or(negated OR own_negation) OVER (PARTITION BY key, grp) AS turned FROM r_timed),
r_raised AS (SELECT *, CASE WHEN n_marks > 0 THEN {one("p1 * pow(CAST(1.25 AS DOUBLE), n_marks)")} ELSE p1 END AS p2 FROM r_values),
rated AS (SELECT key, avg(CASE WHEN turned THEN p2 * CAST(-0.5 AS DOUBLE) ELSE p2 END) AS polarity, CASE WHEN count(*) = count(s1) THEN avg(s1) END AS subjectivity
  FROM r_raised WHERE NOT goes_on GROUP BY 1)"""


def scored(source: str, valences: dict[str, float] | None = None, whole: bool = False) -> str:
    """CTEs ending in `scored`: (key, compound, pos, neg, neu, polarity, subjectivity, ensemble) of source(key, txt)."""
    upper = lambda w: f"({w} = upper({w}) AND {w} <> lower({w}))"
    steps, prev = [], "s0"
    for d, damp in ((1, 1.0), (2, 0.95), (3, 0.9)):
        cap = f"CASE WHEN mixed AND {upper(f'w{d}')} THEN CASE WHEN {prev} > 0 THEN 0.733 ELSE -0.733 END ELSE 0.0 END"
        boost = f"(CASE WHEN {prev} < 0 THEN -b{d} ELSE b{d} END + CAST({cap} AS DOUBLE)) * CAST({damp} AS DOUBLE)"
        free = f"(pl > {d} AND v{d} IS NULL)"
        moved = f"({prev} + coalesce(CASE WHEN {free} THEN {boost} END, CAST(0.0 AS DOUBLE)))"
        so = {1: None, 2: "lower(w1) IN ('so', 'this')", 3: "(lower(w2) IN ('so', 'this') OR lower(w1) IN ('so', 'this'))"}[d]
        never = (
            f"WHEN {free} AND lower(w{d}) = 'never' AND {so} THEN {moved} * CAST({1.5 if d == 2 else 1.25} AS DOUBLE) "
            if so
            else ""
        )
        steps.append(
            f"step{d} AS (SELECT *, CASE {never}WHEN {free} AND coalesce(n{d}, false) THEN {moved} * "
            f"CAST({NEGATION_FACTOR} AS DOUBLE) ELSE {moved} END AS s{d} FROM {'words' if d == 1 else f'step{d - 1}'})"
        )
        prev = f"s{d}"
    lags = ", ".join(
        f"lag({c}, {d}) OVER (PARTITION BY key ORDER BY pl) AS {c}{d}" for d in (1, 2, 3) for c in ("w", "v", "b", "n")
    )
    last, part, rated = "step3", "", MEAN_RATED
    if whole:
        lags += ", " + ", ".join(f"lead(w, {d}) OVER (PARTITION BY key ORDER BY pl) AS f{d}" for d in (1, 2))
        steps.append(f"step4 AS (SELECT * REPLACE ({phrased(A.TEXT_IDIOMS, A.TEXT_PHRASE_BOOSTERS)} AS s3) FROM step3)")
        rated = assessed(A.TEXT_INTENSITIES)
        last, part = "step4", " AND NOT (lower(w) = 'kind' AND coalesce(lower(f1) = 'of', false))"
    return f"""
scoring AS ({scoring_rows(valences or A.TEXT_VALENCES)}),
cleaned AS MATERIALIZED (SELECT key, {clean("coalesce(txt, '')", WORDS)} AS c FROM {source}),
split AS MATERIALIZED (SELECT key, c, list_transform(list_filter(string_split(c, ' '), lambda w: length(w) > 1),
    lambda w: CASE WHEN length(regexp_replace(w, '^[!?.,;:()_]+|[!?.,;:()_]+$', '', 'g')) <= 2 THEN w
      ELSE regexp_replace(w, '^[!?.,;:()_]+|[!?.,;:()_]+$', '', 'g') END) AS ws FROM cleaned),
flagged AS MATERIALIZED (SELECT key, ws, len(list_filter(ws, lambda x: {upper("x")})) BETWEEN 1 AND len(ws) - 1 AS mixed,
    coalesce(list_position(list_transform(ws, lambda x: lower(x)), 'but'), 0) AS but FROM split),
placed AS (SELECT key, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS pl, mixed, but FROM flagged),
found AS (SELECT placed.*, g.v, g.b, g.n, g.p, g.s FROM placed LEFT JOIN scoring g ON g.term = lower(w)),
words AS (SELECT *, v + CASE WHEN mixed AND {upper("w")} THEN CASE WHEN v > 0 THEN CAST(0.733 AS DOUBLE)
    ELSE CAST(-0.733 AS DOUBLE) END ELSE CAST(0.0 AS DOUBLE) END AS s0 FROM (SELECT *, {lags} FROM found)),
{", ".join(steps)},
valued AS (SELECT key, pl, (CASE WHEN pl > 1 AND lower(w1) = 'least' AND v1 IS NULL
      AND NOT coalesce(lower(w2) IN ('at', 'very'), false) THEN s3 * CAST({NEGATION_FACTOR} AS DOUBLE) ELSE s3 END)
    * CASE WHEN but > 0 AND pl < but THEN CAST(0.5 AS DOUBLE) WHEN but > 0 AND pl > but THEN CAST(1.5 AS DOUBLE)
      ELSE CAST(1.0 AS DOUBLE) END AS x
  FROM {last} WHERE v IS NOT NULL AND b IS NULL{part}),
folded AS (SELECT key, list(x ORDER BY pl) AS xs FROM valued GROUP BY 1),
{rated},
summed AS (
  SELECT split.key, c, len(ws) AS n_words, polarity, subjectivity,
    coalesce(list_reduce(list_prepend(CAST(0.0 AS DOUBLE), xs), lambda a, b: a + b), 0.0) AS s,
    coalesce(list_sum(list_transform(list_filter(xs, lambda x: x > 0), lambda x: x + 1)), 0.0) AS pos,
    coalesce(list_sum(list_transform(list_filter(xs, lambda x: x < 0), lambda x: 1 - x)), 0.0) AS neg,
    len(ws) - coalesce(len(list_filter(xs, lambda x: x <> 0)), 0) AS neu,
    least(length(c) - length(replace(c, '!', '')), 4) * CAST(0.292 AS DOUBLE)
      + CASE WHEN length(c) - length(replace(c, '?', '')) <= 1 THEN CAST(0.0 AS DOUBLE)
        WHEN length(c) - length(replace(c, '?', '')) <= 3 THEN (length(c) - length(replace(c, '?', ''))) * CAST(0.18 AS DOUBLE)
        ELSE CAST(0.96 AS DOUBLE) END AS e
  FROM split LEFT JOIN folded ON folded.key = split.key LEFT JOIN rated ON rated.key = split.key),
shaped AS (SELECT *, CASE WHEN s > 0 THEN s + e WHEN s < 0 THEN s - e ELSE s END AS t,
    pos + CASE WHEN pos > neg THEN e ELSE CAST(0.0 AS DOUBLE) END AS pe,
    neg + CASE WHEN neg > pos THEN e ELSE CAST(0.0 AS DOUBLE) END AS ne FROM summed),
scored AS (
  SELECT key, CASE WHEN c = '' THEN 0.0 ELSE round(t / sqrt(t * t + 15), 4) END AS compound,
    coalesce(round(pe / nullif(pe + ne + neu, 0), 3), 0.0) AS pos,
    coalesce(round(ne / nullif(pe + ne + neu, 0), 3), 0.0) AS neg,
    CASE WHEN c = '' THEN 1.0 ELSE coalesce(round(neu / nullif(pe + ne + neu, 0), 3), 0.0) END AS neu,
    coalesce(polarity, 0.0) AS polarity, coalesce(subjectivity, 0.0) AS subjectivity,
    greatest(-1.0, least(1.0, CAST(0.7 AS DOUBLE) * CASE WHEN c = '' THEN 0.0 ELSE round(t / sqrt(t * t + 15), 4) END
      + CAST(0.3 AS DOUBLE) * coalesce(polarity, 0.0))) AS ensemble
  FROM shaped)"""


def sentences(x: str) -> str:
    return f"string_split(regexp_replace({x}, '([.!?])[{SP}]+', '\\1' || chr(1), 'g'), chr(1))"


def text_mentions(whole: bool = False) -> str:
    """CTEs ending in `tech_scores`, `whole` with the phrases and intensities of the adapters."""
    return f"""
{TEXT_RECORDS},
full_posts AS (SELECT id AS post_id, title, text, title || ' ' || text AS full_text, created_date, score, permalink,
    subreddit, subreddit_id, num_comments FROM text_records),
named AS (SELECT post_id, unnest({mentions_of("lower(full_text)", TERM_PAIRS)}) AS tech_name, full_text, created_date
  FROM full_posts),
contexts AS (SELECT post_id, tech_name, created_date, post_id || '/' || tech_name AS key,
    array_to_string(list_filter({sentences("full_text")}, lambda s: contains(lower(s), tech_name)), ' ') AS txt FROM named),
{scored("contexts", whole=whole)},
tech_scores AS (SELECT post_id, tech_name, created_date, txt AS context, ensemble AS score
  FROM contexts JOIN scored USING (key))"""


TEXT_MENTIONS = text_mentions()


def dictionary_pairs(dictionary: dict) -> list[tuple[str, str]]:
    """(term, name) of a dictionary of (name, aliases, weight) by category, the last name of a term counting."""
    pairs: dict[str, str] = {}
    for items in dictionary.values():
        for name, aliases, _ in items:
            for term in [name, *aliases]:
                pairs[term] = name
    return list(pairs.items())


def fuzzy(prefix: str, texts: str, pairs: list[tuple[str, str]]) -> str:
    """Named tables that end in {prefix}names (post_id, names): of the five best terms with a score of 80 or more against
    `texts` (post_id, low). Terms have two letters or more.

    A window of a text that scores so has all but a fifth of the term's letters, so it keeps at least
    length - 1 - 3 * (letters lacking) of the term's pairs of neighbours; windows over an end of the text hold two thirds of
    its letters. The common subsequence of these windows is counted by bits: a bit is 0 where a prefix of the term has
    one letter more in common with the window than the prefix before it.
    """
    rows = values([(i, t, n) for i, (t, n) in enumerate(pairs)], "idx, term, name")
    steps = f"(SELECT *, every AS s FROM {prefix}bits)"
    for k in range(1, max(len(t) for t, _ in pairs) + 1):
        met = f"(s & coalesce(places[{k}], 0))"
        steps = f"(SELECT * REPLACE (((s + {met}) | (s - {met})) & every AS s) FROM {steps})"
    top = max(len(t) for t, _ in pairs)
    return rf"""{prefix}ends AS MATERIALIZED (
  SELECT post_id, length(low) AS n, regexp_extract_all(low[1:{top}], '(?s).') AS head, regexp_extract_all(low[greatest(length(low) - {top} + 1, 1):length(low)], '(?s).') AS tail
  FROM {texts} WHERE low <> ''),
{prefix}terms AS MATERIALIZED (
  SELECT idx, name, term, letters, len(letters) AS m, len(letters) - 1 - 3 * (len(letters) - CAST(ceil(0.8 * len(letters) - 1e-9) AS INTEGER)) AS least
  FROM (SELECT *, regexp_extract_all(term, '(?s).') AS letters FROM {rows})),
{prefix}pairs AS MATERIALIZED (SELECT DISTINCT idx, m, least, unnest(list_transform(range(1, m), lambda i: letters[i] || letters[i + 1])) AS pair FROM {prefix}terms),
{prefix}places AS MATERIALIZED (
  SELECT post_id, n, p, substring(low, p, {top}) AS ahead FROM (SELECT post_id, low, length(low) AS n, unnest(range(1, length(low))) AS p FROM {texts} WHERE low <> '')),
{prefix}hits AS (
  SELECT idx, post_id, n, m, p, lead(p, least - 1) OVER (PARTITION BY idx, post_id ORDER BY p) AS last
  FROM {prefix}places x JOIN {prefix}pairs y ON y.pair = substring(x.ahead, 1, 2) WHERE n > m),
{prefix}inner AS (
  SELECT DISTINCT idx, post_id, unnest(range(greatest(last - m + 2, 1), least(p, n - m + 1) + 1)) AS p FROM {prefix}hits WHERE last - p <= m - 2),
{prefix}windows AS MATERIALIZED (
  SELECT idx, post_id, term AS short, substring(ahead, 1, m) AS part FROM {prefix}inner JOIN {prefix}terms USING (idx) JOIN {prefix}places USING (post_id, p)
  UNION ALL
  SELECT idx, post_id, term, array_to_string(CASE WHEN at_end THEN tail[len(tail) - w + 1:len(tail)] ELSE head[1:w] END, '')
  FROM (SELECT *, unnest(range(CAST(ceil(2 * m / 3) AS BIGINT), m)) AS w FROM {prefix}terms) JOIN {prefix}ends ON n > m, (VALUES (true), (false)) AS e(at_end)
  UNION ALL
  SELECT idx, post_id, array_to_string(short, ''), array_to_string(long[greatest(start, 1):start + len(short) - 1], '') FROM (
    SELECT idx, post_id, short, long, unnest(range(2 - len(short), len(long) + 1)) AS start FROM (
      SELECT idx, post_id, head AS short, letters AS long FROM {prefix}terms JOIN {prefix}ends ON n <= m
      UNION ALL SELECT idx, post_id, letters, head FROM {prefix}terms JOIN {prefix}ends ON n = m))),
{prefix}letters AS MATERIALIZED (
  SELECT short, letter, CAST(sum(1::BIGINT << (i - 1)) AS BIGINT) AS bits
  FROM (SELECT short, unnest(regexp_extract_all(short, '(?s).')) AS letter, generate_subscripts(regexp_extract_all(short, '(?s).'), 1) AS i FROM (SELECT DISTINCT short FROM {prefix}windows))
  GROUP BY short, letter),
{prefix}bits AS MATERIALIZED (
  SELECT short, part, list(coalesce(bits, 0) ORDER BY k) AS places, length(short) AS size, (1::BIGINT << length(short)) - 1 AS every
  FROM (SELECT short, part, unnest(regexp_extract_all(part, '(?s).')) AS letter, generate_subscripts(regexp_extract_all(part, '(?s).'), 1) AS k
    FROM (SELECT DISTINCT short, part FROM {prefix}windows)) LEFT JOIN {prefix}letters USING (short, letter) GROUP BY short, part),
{prefix}common AS MATERIALIZED (SELECT short, part, 200.0::DOUBLE * (size - bit_count(s)) / (size + length(part)) AS score FROM {steps}),
{prefix}scores AS (SELECT idx, post_id, max(score) AS score FROM {prefix}windows JOIN {prefix}common USING (short, part) WHERE score >= 80 GROUP BY idx, post_id),
{prefix}best AS (SELECT * FROM {prefix}scores QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY score DESC, idx) <= 5),
{prefix}names AS (SELECT post_id, string_agg(DISTINCT name, '|' ORDER BY name) AS names FROM {prefix}best JOIN {prefix}terms USING (idx) GROUP BY post_id)"""
