"""SQL fragments the checks are put together from (DuckDB dialect, each a common table expression)."""

from __future__ import annotations

from corpusloom.functions.words import EXTRA_STOP_WORDS, PUNCTUATION, RELATED_TERMS, STOP_WORDS


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


STOP = quoted(STOP_WORDS)
STOP_PLUS = quoted(STOP_WORDS + EXTRA_STOP_WORDS)
MARKS = PUNCTUATION.replace("'", "''")
RELATED = " OR ".join(f"contains(body, '{t}')" for t in RELATED_TERMS)


def token_list(text: str) -> str:
    return (
        rf"list_filter(regexp_extract_all(lower({text}), '[\p{{L}}\p{{Nl}}\p{{No}}_]+'), "
        "lambda w: length(w) BETWEEN 2 AND 15 AND NOT starts_with(w, '_'))"
    )


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CORPUS = "corpus AS (SELECT doc_id AS paper_number, text FROM documents)"
LISTS = f"lists AS (SELECT paper_number, {token_list('text')} AS tokens FROM corpus)"
# one row per token with its place in the document
TOKENS = "tokens AS (SELECT paper_number, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM lists)"
KEPT = f"kept AS (SELECT * FROM tokens WHERE term NOT IN ({STOP_PLUS}))"

_REGION = "^[^aeiouy]*[aeiouy]+[^aeiouy]"
_SHORT = "([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"
_STEP2 = (
    "ization|ational|fulness|ousness|iveness|tional|biliti|lessli|entli|ation|alism|aliti|ousli|iviti|fulli|"
    "enci|anci|abli|izer|ator|alli|bli|ogi|li"
)
_STEP3 = "ational|tional|alize|icate|iciti|ative|ical|ness|ful"
_STEP4 = "ement|ance|ence|able|ible|ment|ant|ent|ism|ate|iti|ous|ive|ize|ion|al|er|ic"
# The Snowball English stemmer as a chain of relational steps over the distinct words.
STEMS = rf"""words AS (SELECT DISTINCT term FROM kept),
y_marked AS (SELECT term, regexp_replace(regexp_replace(term, '^y', 'Y'), '([aeiouy])y', '\1Y', 'g') AS w FROM words),
region1 AS (SELECT *, CASE WHEN regexp_matches(w, '^(gener|commun|arsen)') THEN length(regexp_extract(w, '^(gener|commun|arsen)'))
  WHEN regexp_matches(w, '{_REGION}') THEN length(regexp_extract(w, '{_REGION}')) ELSE length(w) END AS r1 FROM y_marked),
region2 AS (SELECT *, CASE WHEN regexp_matches(substr(w, r1 + 1), '{_REGION}')
  THEN r1 + length(regexp_extract(substr(w, r1 + 1), '{_REGION}')) ELSE length(w) END AS r2 FROM region1),
singular AS (SELECT * EXCLUDE (w), CASE WHEN w LIKE '%sses' THEN left(w, length(w) - 2)
  WHEN w LIKE '%ied' OR w LIKE '%ies' THEN left(w, length(w) - 3) || (CASE WHEN length(w) > 4 THEN 'i' ELSE 'ie' END)
  WHEN w LIKE '%us' OR w LIKE '%ss' THEN w
  WHEN w LIKE '%s' AND regexp_matches(left(w, greatest(length(w) - 2, 0)), '[aeiouy]') THEN left(w, length(w) - 1)
  ELSE w END AS w FROM region2),
past AS (SELECT *, regexp_extract(w, '(eedly|eed|ingly|edly|ing|ed)$') AS sfx FROM singular),
past_base AS (SELECT *, left(w, length(w) - length(sfx)) AS base FROM past),
present AS (SELECT * EXCLUDE (w, sfx, base), CASE WHEN sfx = '' THEN w
  WHEN sfx LIKE 'eed%' THEN CASE WHEN length(base) >= r1 THEN base || 'ee' ELSE w END
  WHEN NOT regexp_matches(base, '[aeiouy]') THEN w
  WHEN regexp_matches(base, '(at|bl|iz)$') THEN base || 'e'
  WHEN regexp_matches(base, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN left(base, length(base) - 1)
  WHEN length(base) <= r1 AND regexp_matches(base, '{_SHORT}') THEN base || 'e'
  ELSE base END AS w, w AS settled FROM past_base),
y_final AS (SELECT * EXCLUDE (w), CASE WHEN length(w) > 2 AND regexp_matches(w, '[^aeiouy][yY]$')
  THEN left(w, length(w) - 1) || 'i' ELSE w END AS w FROM present),
two AS (SELECT *, regexp_extract(w, '({_STEP2})$') AS sfx FROM y_final),
two_base AS (SELECT *, left(w, length(w) - length(sfx)) AS base FROM two),
two_done AS (SELECT * EXCLUDE (w, sfx, base), CASE WHEN sfx = '' OR length(base) < r1 THEN w
  WHEN sfx = 'li' THEN CASE WHEN regexp_matches(base, '[cdeghkmnrt]$') THEN base ELSE w END
  WHEN sfx = 'ogi' THEN CASE WHEN base LIKE '%l' THEN base || 'og' ELSE w END
  WHEN sfx = 'tional' THEN base || 'tion' WHEN sfx = 'enci' THEN base || 'ence' WHEN sfx = 'anci' THEN base || 'ance'
  WHEN sfx = 'abli' THEN base || 'able' WHEN sfx = 'entli' THEN base || 'ent'
  WHEN sfx IN ('izer', 'ization') THEN base || 'ize' WHEN sfx IN ('ational', 'ation', 'ator') THEN base || 'ate'
  WHEN sfx IN ('alism', 'aliti', 'alli') THEN base || 'al' WHEN sfx IN ('fulness', 'fulli') THEN base || 'ful'
  WHEN sfx IN ('ousli', 'ousness') THEN base || 'ous' WHEN sfx IN ('iveness', 'iviti') THEN base || 'ive'
  WHEN sfx IN ('biliti', 'bli') THEN base || 'ble' WHEN sfx = 'lessli' THEN base || 'less' END AS w FROM two_base),
three AS (SELECT *, regexp_extract(w, '({_STEP3})$') AS sfx FROM two_done),
three_base AS (SELECT *, left(w, length(w) - length(sfx)) AS base FROM three),
three_done AS (SELECT * EXCLUDE (w, sfx, base), CASE WHEN sfx = '' OR length(base) < r1 THEN w
  WHEN sfx = 'ative' THEN CASE WHEN length(base) >= r2 THEN base ELSE w END
  WHEN sfx = 'tional' THEN base || 'tion' WHEN sfx = 'ational' THEN base || 'ate' WHEN sfx = 'alize' THEN base || 'al'
  WHEN sfx IN ('icate', 'iciti', 'ical') THEN base || 'ic' ELSE base END AS w FROM three_base),
four AS (SELECT *, regexp_extract(w, '({_STEP4})$') AS sfx FROM three_done),
four_base AS (SELECT *, left(w, length(w) - length(sfx)) AS base FROM four),
four_done AS (SELECT * EXCLUDE (w, sfx, base), CASE WHEN sfx = '' OR length(base) < r2 THEN w
  WHEN sfx = 'ion' THEN CASE WHEN regexp_matches(base, '[st]$') THEN base ELSE w END ELSE base END AS w FROM four_base),
five AS (SELECT *, CASE WHEN w LIKE '%e' THEN CASE WHEN length(w) > r2
      OR (length(w) > r1 AND NOT regexp_matches(left(w, length(w) - 1), '{_SHORT}')) THEN left(w, length(w) - 1) ELSE w END
  WHEN w LIKE '%ll' AND length(w) > r2 THEN left(w, length(w) - 1) ELSE w END AS last FROM four_done),
stems AS (SELECT term, CASE WHEN length(term) <= 2 THEN term
  WHEN term IN ('news', 'howe', 'atlas', 'cosmos', 'bias', 'andes', 'sky') THEN term
  WHEN term = 'skis' THEN 'ski' WHEN term = 'skies' THEN 'sky'
  WHEN term IN ('dying', 'lying', 'tying') THEN left(term, 1) || 'ie'
  WHEN term IN ('idly', 'gently', 'singly') THEN left(term, length(term) - 1)
  WHEN term IN ('ugly', 'early', 'only') THEN left(term, length(term) - 1) || 'i'
  WHEN settled IN ('inning', 'outing', 'canning', 'herring', 'earring', 'proceed', 'exceed', 'succeed') THEN settled
  ELSE replace(last, 'Y', 'y') END AS stem FROM five)"""
CLEAN = "clean AS (SELECT k.paper_number, s.stem AS term, k.pos FROM kept k JOIN stems s ON k.term = s.term)"
CLEANED = with_(CORPUS, LISTS, TOKENS, KEPT, STEMS, CLEAN)
# cleaned tokens as a vectoriser sees them
SEEN = f"seen AS (SELECT * FROM clean WHERE length(term) >= 2 AND term NOT IN ({STOP}))"
STATS = "stats AS (SELECT term, count(*) AS tf, count(DISTINCT paper_number) AS df FROM {source} GROUP BY term)"
SIZE = "total AS (SELECT count(*) AS n_docs FROM documents)"


def vocab(max_features: int, where: str = "true", source: str = "seen") -> str:
    return (
        STATS.format(source=source) + ",\n" + SIZE + ",\n"
        f"vocab AS (SELECT term, tf, df, n_docs FROM stats, total WHERE {where} ORDER BY tf DESC, term LIMIT {max_features})"
    )


def tfidf(source: str = "seen") -> str:
    return f"""cells AS (SELECT paper_number, term, count(*) * (ln((1 + n_docs) / (1 + df)) + 1) AS w
  FROM {source} JOIN vocab USING (term) GROUP BY paper_number, term, n_docs, df),
norms AS (SELECT paper_number, sqrt(sum(w * w)) AS norm FROM cells GROUP BY paper_number),
tfidf AS (SELECT paper_number, term, round(w / norm, 6) AS weight FROM cells JOIN norms USING (paper_number))"""


_PAPER = "cast(conv_id AS VARCHAR)"
ARTICLES = f"""articles AS (SELECT {_PAPER} AS paper_id,
  arg_min(text, turn) AS title,
  CASE WHEN count(*) FILTER (role <> 'system') > 0 THEN string_agg(role || ' ' || turn, ', ' ORDER BY turn) ELSE '' END AS authors,
  coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (role = 'system'), '') AS abstract,
  coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (role <> 'system'), '') || ' '
    || coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (role = 'system'), '') AS body
  FROM conversations GROUP BY {_PAPER})"""
NUMBERED = "numbered AS (SELECT *, row_number() OVER (ORDER BY paper_id) - 1 AS paper_number FROM articles)"
KEYWORDS = f"""keywords AS (SELECT {_PAPER} AS paper_id,
  cast(row_number() OVER w - 1 AS INT) AS seq, string_agg(text, '') OVER w AS keywords
  FROM conversations WHERE role = 'user' WINDOW w AS (PARTITION BY {_PAPER} ORDER BY turn))"""
META = """metadata AS (SELECT cast(doc_id AS VARCHAR) AS paper_id, source || ' ' || lang AS title, '' AS authors,
  doc_id AS paper_number, 1 AS label FROM documents)"""
LABELS = "sheet AS (SELECT doc_id AS paper_number, quality AS label FROM labels)"
SCORES = """scores AS (SELECT doc_id AS paper_number, cast(length(text) % 97 - 48 AS DOUBLE) AS score,
  CASE WHEN length(text) % 97 - 48 > 0 THEN 1 ELSE 0 END AS prediction FROM documents)"""
WEIGHTS = """weights AS (SELECT vec_id AS paper_number, unnest(embedding) AS raw,
  generate_subscripts(embedding, 1) - 1 AS topic FROM embeddings),
rounded AS (SELECT paper_number, topic, round_even(cast(raw AS DOUBLE), 2) AS weight FROM weights)"""
RANKED = """unlabelled AS (SELECT * FROM scores WHERE paper_number NOT IN (SELECT paper_number FROM sheet)),
ranked AS (SELECT paper_number, score, row_number() OVER (ORDER BY score, paper_number) - 1 AS rank FROM unlabelled)"""
BATCH = """sizes AS (SELECT (SELECT count(*) FROM ranked) AS u, (SELECT count(*) FROM scores) // 2 AS m),
batch AS (SELECT paper_number, score, rank, 'low' AS slice FROM ranked WHERE rank < 67
  UNION ALL SELECT paper_number, score, rank, 'high' FROM ranked, sizes WHERE rank >= u - 67
  UNION ALL SELECT paper_number, score, rank, 'mid_up' FROM ranked, sizes WHERE rank >= m AND rank < m + 33
  UNION ALL SELECT paper_number, score, rank, 'mid_down' FROM ranked, sizes WHERE rank >= m - 33 AND rank < m)"""


def curve_cells(steps: int, repeats: int, per_class: int, seed: str) -> str:
    """Dev sets and samples of a learning curve."""
    return f"""ks AS (SELECT cast(unnest(range(0, {steps + 1})) AS INT) AS size_idx),
dev_cells AS (SELECT k.size_idx, r.repeat FROM ks k,
  LATERAL (SELECT cast(unnest(range(0, CASE WHEN k.size_idx = 0 THEN {repeats} ELSE 1 END)) AS INT) AS repeat) r),
dev AS (SELECT size_idx, repeat, paper_number, label FROM (SELECT *, row_number() OVER (
    PARTITION BY size_idx, repeat, label
    ORDER BY md5('{seed}:dev:' || size_idx || ':' || repeat || ':' || paper_number), paper_number) AS rn
  FROM dev_cells, sheet) WHERE rn <= {per_class}),
pool AS (SELECT size_idx, paper_number, label FROM ks, sheet WHERE size_idx > 0
  AND (size_idx, paper_number) NOT IN (SELECT (size_idx, paper_number) FROM dev)),
drawn AS (SELECT size_idx, repeat, paper_number, label FROM (SELECT *,
    count(*) OVER (PARTITION BY size_idx, repeat) AS n_rest,
    row_number() OVER (PARTITION BY size_idx, repeat
      ORDER BY md5('{seed}:' || size_idx || ':' || repeat || ':' || paper_number), paper_number) AS rn
  FROM pool, (SELECT cast(unnest(range(0, {repeats})) AS INT) AS repeat)) WHERE rn <= n_rest // {steps} * size_idx)"""
