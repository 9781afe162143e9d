"""The operators of this package as queries over the tables."""

from __future__ import annotations

from areacast.llm import chat, decontaminate, langid, lm, mixing, neighbours, passages, pii, quality, simhash, spelling, tokens, whitening
from areacast.llm.common import table


def op1_multiprobe_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op2_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicate_components(table(spark, sf_dir, "documents"))


def op3_language_id(spark, sf_dir):
    return langid.language_predictions(table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(rows.unionByName(chat.marked_conversation(spark)))


def op5_benchmark_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_lm_scoring(spark, sf_dir):
    return lm.language_model_scores(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_files(spark, sf_dir):
    return tokens.token_digests(table(spark, sf_dir, "documents"))


def op9_target_mixing(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark, sf_dir):
    return passages.repeat_removal(table(spark, sf_dir, "documents"))


def op11_pii(spark, sf_dir):
    return pii.pii_spans(table(spark, sf_dir, "documents"))


def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_multiprobe_neighbours, op2_simhash_near_dedup, op3_language_id, op4_chat_formatting, op5_benchmark_decontamination,
        op6_lm_scoring, op7_quality_classifier, op8_token_files, op9_target_mixing, op10_substring_dedup, op11_pii, op12_whitening,
        op13_spelling_variants,
    )
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"


def _spans_sql() -> str:
    """op11: text before and between the matches gives their places."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    kinds = (*pii.BASE, *pii.ADDED)
    raw = " UNION ALL ".join(
        f"SELECT r, {k} AS k, '{kind}' AS kind, t, regexp_split_to_array(t, {quoted(pii.PATTERNS[kind])}) AS parts, regexp_extract_all(t, {quoted(pii.PATTERNS[kind])}) AS hits FROM d"
        for k, kind in enumerate(kinds)
    )
    some = lambda pattern: f"(regexp_matches(before, {quoted(pattern)}) OR regexp_matches(after, {quoted(pattern)}))"
    near = " ".join(f"WHEN '{k}' THEN {some(pii.CONTEXT[k])}" for k in pii.ADDED)
    own = " ".join(f"WHEN '{k}' THEN {pii.SCORES[k]}" for k in pii.ADDED)
    lower = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    base = ", ".join(f"'{k}'" for k in pii.BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
raw AS ({raw}),
hit AS (SELECT r, k, kind, t, hits[i] AS hit,
          list_sum(list_transform(parts[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s
        FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM raw)),
seen AS (SELECT r, k, kind, hit, CAST(s AS BIGINT) AS s, CAST(s + length(hit) AS BIGINT) AS e,
           regexp_replace(hit, '[^0-9]', '', 'g') AS dg, replace(hit, ' ', '') AS z,
           {lower(f"substr(t, greatest(CAST(s AS BIGINT) - {pii.REACH}, 0) + 1, least({pii.REACH}, CAST(s AS BIGINT)))")} AS before,
           {lower(f"substr(t, CAST(s AS BIGINT) + length(hit) + 1, {pii.REACH})")} AS after
         FROM hit),
sure AS (SELECT *, CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN list_bool_and(list_transform(string_split(hit, '.'), lambda x: length(ltrim(x, '0')) <= 3 AND coalesce(TRY_CAST(ltrim(x, '0') AS INTEGER), 0) <= 255))
    WHEN 'card' THEN length(dg) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(dg) + 1), lambda i:
        CASE WHEN i % 2 = 1 THEN ascii(substr(dg, length(dg) - i + 1, 1)) - 48
             ELSE (2 * (ascii(substr(dg, length(dg) - i + 1, 1)) - 48)) // 10 + (2 * (ascii(substr(dg, length(dg) - i + 1, 1)) - 48)) % 10 END)) % 10 = 0
    WHEN 'phone' THEN length(dg) BETWEEN 9 AND 15
    WHEN 'iban' THEN length(z) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(string_split(substr(z, 5) || substr(z, 1, 4), ''), lambda c:
        CASE WHEN c <= '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)), lambda a, c: (a * CASE WHEN c >= 10 THEN 100 ELSE 10 END + c) % 97) = 1
    WHEN 'ssn' THEN substr(hit, 1, 3) NOT IN ('000', '666') AND substr(hit, 1, 1) <> '9' AND substr(hit, 5, 2) <> '00' AND substr(hit, 8, 4) <> '0000'
    ELSE substr(hit, 1, 1) >= '2' END AS valid FROM seen),
weighed AS (SELECT *, kind IN ({base}) OR
    CASE kind {own} END + {pii.NEAR} * (CAST(CASE kind {near} END AS INTEGER) - CAST({some(pii.COUNTER)} AS INTEGER)) >= {pii.KEEP} AS good
    FROM sure WHERE valid),
kept AS (SELECT * FROM weighed WHERE good AND (kind IN ({base}, 'iban')
    OR NOT EXISTS (SELECT 1 FROM weighed o WHERE o.r = weighed.r AND o.good AND o.kind IN ({base}, 'iban') AND o.s < weighed.e AND weighed.s < o.e)))
SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in pii.BASE)},
  sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (kind IN ({base})), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (kind IS NOT NULL), '') AS spans
FROM d LEFT JOIN kept USING (r) GROUP BY r, doc_id
"""


#: crc32 from its polynomial; near words by what is left without one place.
_SPELLING_SQL = rf"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS steps),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, w, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS w FROM documents) WHERE length(w) >= 7 GROUP BY ALL),
hashed AS (SELECT w, c, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(hex(d || ':' || w)) // 2), lambda i: CAST('0x' || substr(hex(d || ':' || w), 2 * i + 1, 2) AS BIGINT))),
    lambda a, b: xor(steps[(xor(a, b) & 255) + 1], a >> 8))) AS h FROM runs, crc),
typed AS (SELECT CASE WHEN h % 31 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM hashed),
v AS MATERIALIZED (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
less AS MATERIALIZED (SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM v)),
near AS (
  SELECT a.word, b.word AS other FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT less.word, v.word FROM less JOIN v ON less.rest = v.word
  UNION SELECT v.word, less.word FROM less JOIN v ON less.rest = v.word),
best AS (SELECT near.word, count(*) AS n_near, max(o.n) AS best_n, arg_min(o.word, (-o.n, o.word)) AS best FROM near JOIN v o ON o.word = near.other GROUP BY near.word),
forms AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * v.n THEN best END AS form, CASE WHEN best_n >= 10 * v.n THEN best_n END AS form_n FROM v LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS at FROM forms UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NOT NULL)
SELECT forms.word, forms.form, chain.at AS root, forms.n, forms.n_near, forms.form_n FROM forms JOIN chain USING (word) JOIN forms ends ON ends.word = chain.at WHERE ends.form IS NULL
"""


ORACLE_SQL: dict[str, str] = {
    "op11_pii": _spans_sql(),
    "op13_spelling_variants": _SPELLING_SQL,
    "op5_benchmark_decontamination": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i:i + 12], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT k FROM win),
occ AS (
  SELECT c.r, c.i, c.k, win.item_id
  FROM (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS p
        FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)) c
  JOIN win ON win.k = c.k AND win.p = c.p
),
hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM occ) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
""",
    "op10_substring_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS p
        FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13 AND doc_id IS NOT NULL)),
least_id AS (SELECT p, min(doc_id) AS m FROM win GROUP BY p),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS j FROM win JOIN least_id USING (p) WHERE m < doc_id),
word AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS t FROM word ANTI JOIN gone USING (r, j) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
""",
}
