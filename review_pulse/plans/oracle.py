"""Independent SQL statements of the catalogue queries, for DuckDB over the same tables.

They are written relationally where the Spark side works inside the row (the normaliser unnests
words and joins its word lists, for instance), so that both sides check each other.
"""

from __future__ import annotations

from review_pulse.functions import lexicon

# Python's \s as an RE2 class body.
_WS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _texts(values) -> str:
    return ", ".join(_text(v) for v in values)


_RATINGS = """ratings AS (
  SELECT *, CASE WHEN overall < 3 THEN 0 WHEN overall = 3 THEN 1 ELSE 2 END AS label
  FROM (SELECT CAST(event_id AS VARCHAR) AS review_id, CAST(user_id AS VARCHAR) AS reviewer_id,
               json_extract_string(props, '$.k') AS asin,
               CAST(5 - least(4, floor(value / 25)) AS DOUBLE) AS overall,
               ts, event_id, event_type, props
        FROM events))"""

_REVIEWS = _RATINGS + """,
reviews AS (
  SELECT r.*, d.text AS review_text, strftime(r.ts, '%Y-%m-%d') AS review_time
  FROM ratings r LEFT JOIN documents d ON d.doc_id = r.event_id)"""

_PREDICTIONS = _RATINGS + """,
predictions AS (
  SELECT review_id, reviewer_id, asin, label,
         CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 7 = 0 THEN 1 ELSE label END
           AS predicted_label,
         ts AS ingestion_time
  FROM ratings)"""


# Rows in the waves they arrive in, with the newest time of earlier waves as the watermark has it.
_WAVES = _PREDICTIONS + """,
waved AS (
  SELECT *, least(3, (day(ingestion_time) - 1) // 10 + CASE WHEN CAST(review_id AS BIGINT) % 13 = 0 THEN 1 ELSE 0 END) AS wave
  FROM predictions WHERE predicted_label IS NOT NULL),
seen AS (
  SELECT wave, max(max(date_trunc('milliseconds', ingestion_time))) OVER (
    ORDER BY wave ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
  FROM waved GROUP BY wave),
arrived AS (SELECT * FROM waved JOIN seen USING (wave))"""


def _percent(part: str, total: str) -> str:
    return (
        f"CASE WHEN {total} > 0 THEN CAST((2000 * {part} + {total}) // (2 * {total}) AS DOUBLE) / 10"
        f" ELSE 0.0 END"
    )


_TALLIES = """count(*) FILTER (predicted_label = 0) AS negative,
         count(*) FILTER (predicted_label = 1) AS neutral,
         count(*) FILTER (predicted_label = 2) AS positive"""

_PERCENTAGES = ", ".join(
    f"CAST({_percent(name, 'total')} AS DOUBLE) AS {name}_pct" for name in ("negative", "neutral", "positive")
)


def _counts(columns: str) -> str:
    return f"""WITH {_PREDICTIONS},
classes(label, sentiment) AS (VALUES (0, 'Negative'), (1, 'Neutral'), (2, 'Positive')),
counted AS (
  SELECT c.label, c.sentiment, count(p.review_id) AS reviews
  FROM classes c LEFT JOIN predictions p ON p.predicted_label = c.label GROUP BY ALL),
totalled AS (SELECT *, CAST(sum(reviews) OVER () AS BIGINT) AS total FROM counted)
SELECT {columns} FROM totalled"""


_TREND = f"""WITH {_PREDICTIONS},
bounds AS (SELECT max(ingestion_time) AS hi, max(ingestion_time) - INTERVAL 7 DAY AS lo FROM predictions),
days AS (SELECT CAST(unnest(generate_series(CAST(lo AS DATE), CAST(hi AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
         FROM bounds),
inside AS (SELECT p.* FROM predictions p, bounds
           WHERE predicted_label IS NOT NULL AND ingestion_time BETWEEN lo AND hi)
SELECT strftime(d, '%Y-%m-%d') AS day, {_TALLIES}
FROM days LEFT JOIN inside ON CAST(ingestion_time AS DATE) = d GROUP BY d"""


def _top(key: str) -> str:
    return f"""WITH {_PREDICTIONS},
grouped AS (
  SELECT {key}, {_TALLIES}, count(*) AS total
  FROM predictions WHERE predicted_label IS NOT NULL AND {key} IS NOT NULL
  GROUP BY {key} HAVING count(*) >= 2 ORDER BY total DESC, {key} LIMIT 10)
SELECT *, {_PERCENTAGES} FROM grouped"""


def _product(asin: str) -> str:
    return f"""WITH {_PREDICTIONS},
grouped AS (
  SELECT {_text(asin)} AS asin, {_TALLIES}, count(*) AS total
  FROM predictions WHERE predicted_label IS NOT NULL AND asin = {_text(asin)})
SELECT *, {_PERCENTAGES} FROM grouped"""


def _recent(limit: int, text: str) -> str:
    return f"""WITH {_PREDICTIONS}
SELECT review_id, reviewer_id, predicted_label,
       CASE predicted_label WHEN 0 THEN 'Negative' WHEN 1 THEN 'Neutral' ELSE 'Positive' END AS sentiment,
       strftime(ingestion_time, '%Y-%m-%d %H:%M:%S') AS ingestion_time{text}
FROM predictions LEFT JOIN documents ON CAST(doc_id AS VARCHAR) = review_id
WHERE predicted_label IS NOT NULL
ORDER BY predictions.ingestion_time DESC, review_id LIMIT {limit}"""


_SNIPPET = "CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END"

_STATS = f"""WITH {_PREDICTIONS}
SELECT count(*) AS total_predictions, count(predicted_label) AS valid_predictions,
       strftime(max(ingestion_time), '%Y-%m-%d %H:%M:%S') AS latest_prediction,
       'connected' AS connection_status
FROM predictions"""


def _clean_batch(column: str) -> str:
    letters = f"regexp_replace(coalesce({column}, ''), '[^a-zA-Z{_WS}]', '', 'g')"
    return f"trim(regexp_replace(lower({letters}), '[{_WS}]+', ' ', 'g'))"


def _clean_stream(column: str) -> str:
    letters = f"regexp_replace(lower(coalesce({column}, '')), '[^a-z{_WS}]', '', 'g')"
    return f"trim(regexp_replace({letters}, '[{_WS}]+', ' ', 'g'))"


def _placeholder(cleaned: str) -> str:
    return f"CASE WHEN {cleaned} = '' THEN 'no text available' ELSE {cleaned} END"


_CLEANED_DOCS = f"cleaned AS (SELECT doc_id, {_clean_batch('text')} AS t FROM documents)"

_WORDS = f"""{_CLEANED_DOCS},
words AS (
  SELECT doc_id, ws,
         list_filter(ws, lambda w: NOT list_contains([{_texts(lexicon.STOP_WORDS)}], w)) AS fs
  FROM (SELECT doc_id, string_split(t, ' ') AS ws FROM cleaned))"""


def _gram(n: int) -> str:
    """n words in a row, joined, for every place of the list ``fs``."""
    joined = " || ' ' || ".join(f"fs[i + {k}]" if k else "fs[i]" for k in range(n))
    return f"list_transform(generate_series(1, len(fs) - {n - 1}), lambda i: {joined})"


# Murmur hash of a term's bytes, written over lists of bytes: four of them at a time, then the rest.
_ROTATED = "((({x}) << {n}) & 4294967295) | (({x}) >> (32 - {n}))".format
_MULTIPLIED = "(({x})::HUGEINT * {c} % 4294967296)::UBIGINT".format


def _mixed(k: str) -> str:
    once = _MULTIPLIED(x=k, c=0xCC9E2D51)
    return _MULTIPLIED(x=_ROTATED(x=once, n=15), c=0x1B873593)


def _finished(h: str) -> list[str]:
    """Expressions of three steps, each over the ``h`` of the one before."""
    return [_MULTIPLIED(x=f"xor({h}, {h} >> 16)", c=0x85EBCA6B), _MULTIPLIED(x=f"xor({h}, {h} >> 13)", c=0xC2B2AE35), f"xor({h}, {h} >> 16)"]


_STEP_1, _STEP_2, _STEP_3 = _finished("h")
_HASHED = f"""{_WORDS},
terms AS MATERIALIZED (
  SELECT doc_id, 0 AS space, unnest(fs) AS term FROM words
  UNION ALL SELECT doc_id, 1, unnest({_gram(2)}) FROM words
  UNION ALL SELECT doc_id, 2, unnest({_gram(3)}) FROM words),
coded AS (SELECT term, list_transform(string_split(term, ''), lambda c: ord(c)::UBIGINT) AS b
          FROM (SELECT DISTINCT term FROM terms)),
blocks AS (
  SELECT term, len(b)::UBIGINT AS size,
    list_transform(range(0, len(b) // 4), lambda i: b[4 * i + 1] + (b[4 * i + 2] << 8) + (b[4 * i + 3] << 16) + (b[4 * i + 4] << 24)) AS k,
    coalesce(b[len(b) // 4 * 4 + 1], 0) + (coalesce(b[len(b) // 4 * 4 + 2], 0) << 8) + (coalesce(b[len(b) // 4 * 4 + 3], 0) << 16) AS rest
  FROM coded),
mixed AS (
  SELECT term, size, rest, list_reduce(list_prepend(42::UBIGINT, list_transform(k, lambda x: {_mixed('x')})),
    lambda h, x: (({_ROTATED(x='xor(h, x)', n=13)}) * 5 + 3864292196) % 4294967296) AS h
  FROM blocks),
rested AS (SELECT term, xor(xor(h, {_mixed('rest')}), size) AS h FROM mixed),
first_step AS (SELECT term, {_STEP_1} AS h FROM rested),
second_step AS (SELECT term, {_STEP_2} AS h FROM first_step),
hashed AS (SELECT term, {_STEP_3} AS h FROM second_step),
buckets AS MATERIALIZED (
  SELECT term, (((h::BIGINT - CASE WHEN h >= 2147483648 THEN 4294967296 ELSE 0 END) % 1000) + 1000) % 1000 AS bucket FROM hashed)"""


def _listed(words: str, name: str) -> str:
    return f"""WITH {_WORDS}
SELECT doc_id, CAST(len({words}) AS BIGINT) AS n_{name}, coalesce(list_aggregate({words}, 'string_agg', '|'), '')
         AS {name}
FROM words"""


def _grams(n: int, name: str) -> str:
    joined = " || ' ' || ".join(f"fs[i + {k}]" if k else "fs[i]" for k in range(n))
    return f"""WITH {_WORDS},
grams AS (
  SELECT doc_id, list_transform(generate_series(1, len(fs) - {n - 1}), lambda i: {joined}) AS gs FROM words)
SELECT doc_id, CAST(len(gs) AS BIGINT) AS n_{name}, coalesce(list_aggregate(gs, 'string_agg', '|'), '')
         AS {name}
FROM grams"""


def _lemma_case(word: str) -> str:
    """The suffix rules as a CASE over a word column."""
    whens = []
    for ending, shortest, cut, added in lexicon.PLURAL_RULES:
        stem = f"left({word}, length({word}) - {cut}) || '{added}'"
        whens.append(f"WHEN ends_with({word}, '{ending}') AND length({word}) >= {shortest} THEN {stem}")
    for ending, shortest in lexicon.VERB_RULES:
        stem = f"left({word}, length({word}) - {len(ending)})"
        whens.append(
            f"WHEN ends_with({word}, '{ending}') AND length({word}) >= {shortest}"
            f" AND regexp_matches({stem}, '[aeiouy]') THEN {_restored(stem)}"
        )
    return f"CASE {' '.join(whens)} ELSE {word} END"


def _restored(stem: str) -> str:
    doubled = (
        f"regexp_matches({stem}, '[b-df-hj-np-tv-z]$') AND length({stem}) > 1"
        f" AND right({stem}, 1) = left(right({stem}, 2), 1)"
        f" AND right({stem}, 2) NOT IN ({_texts(lexicon.KEPT_DOUBLES)})"
    )
    silent = " OR ".join(f"ends_with({stem}, '{e}')" for e in lexicon.SILENT_E)
    return (
        f"(CASE WHEN {doubled} THEN left({stem}, length({stem}) - 1)"
        f" WHEN {silent} THEN {stem} || 'e' ELSE {stem} END)"
    )


_IRREGULAR = ", ".join(f"({_text(form)}, {_text(lemma)})" for form, lemma in lexicon.irregular_forms().items())

def _lemmas(texts: str) -> str:
    """CTEs that give ``lemmas``: doc_id, cleaned text and lemmatized_text of each row of ``texts``."""
    return f"""cleaned AS (
  SELECT doc_id, {_placeholder('c')} AS t FROM (SELECT doc_id, {_clean_batch('text')} AS c FROM {texts})),
irregular(form, lemma) AS (VALUES {_IRREGULAR}),
positioned AS (
  SELECT doc_id, unnest(string_split(t, ' ')) AS w, generate_subscripts(string_split(t, ' '), 1) AS pos
  FROM cleaned),
reduced AS (
  SELECT doc_id, pos, coalesce(lemma, {_lemma_case('w')}) AS l
  FROM positioned LEFT JOIN irregular ON form = w
  WHERE w NOT IN ({_texts(lexicon.CLEANED_STOP_WORDS)}) AND w <> ''),
joined AS (SELECT doc_id, string_agg(l, ' ' ORDER BY pos) AS j FROM reduced GROUP BY doc_id),
lemmas AS (SELECT doc_id, t, coalesce(j, t) AS lemmatized_text FROM cleaned LEFT JOIN joined USING (doc_id))"""


_LEMMAS = f"WITH {_lemmas('documents')} SELECT doc_id, lemmatized_text FROM lemmas"


def _draw(row_id: str, seed: int = 42) -> str:
    return f"CAST('0x' || substring(md5({row_id} || ':{seed}'), 1, 8) AS BIGINT)"


_SPLIT = (
    f"CASE WHEN {_draw('review_id')} % 10 < 8 THEN 'train' WHEN {_draw('review_id')} % 10 = 8"
    " THEN 'validation' ELSE 'test' END"
)

_SPLIT_ROWS = f"{_RATINGS}, split_rows AS (SELECT review_id, label, {_SPLIT} AS split FROM ratings)"


_REVIEW_SPLIT = (f"{_REVIEWS}, split_rows AS (SELECT review_id, label, {_SPLIT} AS split FROM reviews"
                 " WHERE review_text IS NOT NULL)")

_HELD_OUT_ROWS = f"""WITH {_REVIEW_SPLIT}
SELECT review_id, split, CAST(label AS DOUBLE) AS label, true AS agrees FROM split_rows WHERE split <> 'train'"""


def _rebalanced(source: str, keep: str) -> str:
    """CTEs: class sizes, the target, ranked rows and the rebalanced rows ``balanced``."""
    return f"""sizes AS (SELECT count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1,
                 count(*) FILTER (label = 2) AS n2 FROM {source}),
plan AS (SELECT *, CASE WHEN n0 > 0 THEN least(3 * n0, n2) ELSE n2 END AS target FROM sizes),
ranked AS (SELECT review_id, label, {_draw('review_id')} AS draw,
                  row_number() OVER (PARTITION BY label ORDER BY md5(review_id || ':42'), review_id) AS rank
           FROM {source}),
balanced AS (
  SELECT review_id, label,
         CAST(unnest(generate_series(1, CASE label WHEN 0 THEN greatest(1, target // n0)
                                      WHEN 1 THEN greatest(1, target // n1) ELSE 1 END)) AS INTEGER) AS copy
  FROM ranked, plan WHERE label < 2 OR {keep})"""


_LOPSIDED = f"""{_RATINGS},
lopsided AS (SELECT review_id, CASE WHEN overall <= 1 THEN 0 WHEN overall <= 3 THEN 1 ELSE 2 END AS label
             FROM ratings)"""

_KEEP_EXACT = "rank <= target"
_KEEP_HASH = "draw < 4294967296 * CAST(target AS HUGEINT) // n2"

_CONFUSION = f"""{_PREDICTIONS},
confusion AS (SELECT label, predicted_label AS prediction, count(*) AS n FROM predictions
              WHERE predicted_label IS NOT NULL GROUP BY ALL)"""

_PER_CLASS = f"""{_CONFUSION},
actual AS (SELECT label AS k, CAST(sum(n) AS BIGINT) AS actual,
                  CAST(coalesce(sum(n) FILTER (label = prediction), 0) AS BIGINT) AS hits
           FROM confusion GROUP BY label),
predicted AS (SELECT prediction AS k, CAST(sum(n) AS BIGINT) AS predicted FROM confusion GROUP BY prediction),
rates AS (
  SELECT CAST(k AS DOUBLE) AS class, actual, coalesce(predicted, 0) AS predicted, hits,
         coalesce(hits / nullif(coalesce(predicted, 0), 0), 0.0) AS precision, hits / actual AS recall
  FROM actual LEFT JOIN predicted USING (k)),
per_class AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM rates)"""

_QUARANTINE = f"""WITH {_REVIEWS}
SELECT CASE WHEN review_text IS NULL THEN '{{"overall"' ELSE '{{"reviewTe' END AS value
FROM reviews WHERE event_id % 50 = 0"""

_CODE_INDEX = "CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) AS indexed_label"


def _label_index(order: str) -> str:
    return f"""WITH {_RATINGS}
SELECT label, n, {_CODE_INDEX.format(order=order)}
FROM (SELECT label, count(*) AS n FROM ratings GROUP BY label)"""


# Written out once more, apart from the list that the other side learns from.
_LEMMA_PAIRS = """('walked', 'walk'), ('talked', 'talk'), ('reading', 'read'), ('eating', 'eat'), ('singing', 'sing'),
  ('houses', 'house'), ('dogs', 'dog'), ('cats', 'cat'), ('tables', 'table'), ('stories', 'story'), ('cities', 'city'),
  ('running', 'run'), ('making', 'make'), ('taken', 'take'), ('went', 'go'), ('children', 'child'), ('better', 'good'),
  ('thing', 'thing'), ('bring', 'bring'), ('king', 'king'), ('red', 'red'), ('need', 'need'), ('this', 'this'), ('was', 'be'),
  ('is', 'be'), ('nations', 'nation'), ('motion', 'motion'), ('quickly', 'quickly')"""

# Every ending keeps its best edit; a word takes the one of its longest ending, by a join.
_LEARNED = f"""WITH pairs(form, lemma) AS (VALUES {_LEMMA_PAIRS}),
edits AS (
  SELECT form, length(form) - k AS cut, lemma[k + 1:] AS added
  FROM (SELECT *, coalesce(list_max(list_filter(range(1, least(length(form), length(lemma)) + 1), lambda i: form[:i] = lemma[:i])), 0) AS k
        FROM pairs)),
votes AS (
  SELECT ending, cut, added, count(*) AS n FROM (
    SELECT right(form, n::BIGINT) AS ending, cut, added FROM (SELECT *, unnest(range(1, least(length(form), 5) + 1)) AS n FROM edits) WHERE n >= cut
    UNION ALL SELECT '^' || form, cut, added FROM edits) GROUP BY ALL),
rules AS (SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY ending ORDER BY n DESC, cut, added) = 1),
cleaned AS (SELECT {_clean_batch('text')} AS t FROM documents),
vocabulary AS (SELECT DISTINCT unnest(string_split(t, ' ')) AS word FROM cleaned),
endings AS (
  SELECT word, right(word, unnest(range(1, least(length(word), 5) + 1))::BIGINT) AS ending FROM vocabulary
  UNION ALL SELECT word, '^' || word FROM vocabulary),
longest AS (
  SELECT word, arg_max(cut, length(ending)) AS cut, arg_max(added, length(ending)) AS added
  FROM endings JOIN rules USING (ending) GROUP BY word)
SELECT v.word, CASE WHEN cut IS NULL THEN v.word ELSE left(v.word, length(v.word) - cut) || added END AS lemma
FROM vocabulary v LEFT JOIN longest l ON l.word = v.word"""


SQL: dict[str, str] = {
    "sentiment_trend": _TREND,
    "sentiment_counts": _counts("label, sentiment, reviews, total"),
    "sentiment_share": _counts(f"label, sentiment, CAST({_percent('reviews', 'total')} AS DOUBLE) AS share_pct"),
    "top_reviewers": _top("reviewer_id"),
    "top_products": _top("asin"),
    "top_by_threshold": f"""WITH {_PREDICTIONS},
keyed AS (
  SELECT 'reviewers' AS keys, reviewer_id AS key, predicted_label FROM predictions
  UNION ALL SELECT 'skewed', 'k' || CAST(floor(log2(CAST(reviewer_id AS INTEGER) + 1) * 4) AS BIGINT), predicted_label FROM predictions),
grouped AS (
  SELECT keys, key, {_TALLIES}, count(*) AS total FROM keyed WHERE predicted_label IS NOT NULL GROUP BY ALL HAVING count(*) >= 2)
SELECT * FROM grouped QUALIFY row_number() OVER (PARTITION BY keys ORDER BY total DESC, key) <= 10""",
    "product_lookup": _product("42"),
    "product_lookup_missing": _product("no-such-product"),
    "recent_reviews": _recent(10, f", {_SNIPPET} AS lemmatized_text"),
    "indexed_lookup": f"""WITH {_PREDICTIONS}, scored AS (SELECT * FROM predictions WHERE predicted_label IS NOT NULL),
wanted AS (
  (SELECT review_id FROM scored ORDER BY ingestion_time DESC, review_id LIMIT 10)
  UNION (SELECT review_id FROM scored ORDER BY ingestion_time, review_id LIMIT 10))
SELECT doc_id, lang, n_chars, md5(text) AS text_md5 FROM documents JOIN wanted ON CAST(doc_id AS VARCHAR) = review_id""",
    "store_stats": _STATS,
    "latest_prediction": f"""WITH {_PREDICTIONS}
SELECT strftime(max(ingestion_time), '%Y-%m-%d %H:%M:%S.%f') AS latest FROM predictions""",
    "clean_text_batch": f"SELECT doc_id, {_clean_batch('text')} AS cleaned_text FROM documents",
    "clean_text_stream": f"SELECT doc_id, {_clean_stream('text')} AS cleaned_text FROM documents",
    "text_placeholder": f"""WITH {_RATINGS},
cleaned AS (SELECT review_id, {_clean_batch("CASE WHEN event_type = 'error' THEN asin ELSE event_type END")} AS t
            FROM ratings)
SELECT review_id, {_placeholder('t')} AS cleaned_text FROM cleaned""",
    "empty_text_audit": f"""WITH {_CLEANED_DOCS}
SELECT count(*) AS n_texts, count(*) FILTER (t = '') AS n_empty FROM cleaned""",
    "text_cap": """SELECT doc_id, length(text) AS n_chars, length(left(text, 100000)) AS n_capped,
       md5(left(text, 100000)) AS capped_md5 FROM documents""",
    "text_preview": f"""WITH {_REVIEWS}, sent AS (SELECT *, event_id % 50 IN (0, 2) AS cut FROM reviews)
SELECT CASE WHEN NOT cut THEN review_id END AS review_id,
       CASE WHEN cut THEN 'N/A' ELSE reviewer_id END AS reviewer_id,
       CASE WHEN cut THEN 'N/A' ELSE coalesce(asin, 'N/A') END AS asin,
       CASE WHEN cut OR event_id % 50 = 1 THEN 'N/A' ELSE CAST(overall AS VARCHAR) END AS rating,
       CASE WHEN cut THEN '' ELSE coalesce(left(review_text, 100), '') END AS preview
FROM sent""",
    "text_snippets": f"SELECT doc_id, {_SNIPPET} AS snippet FROM documents",
    "lexicon_lemmas": _LEMMAS,
    "learned_lemmas": _LEARNED,
    "document_preview": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, source,
       CASE WHEN length(text) > 30 THEN left(text, 27) || '...' ELSE text END AS text
FROM documents ORDER BY documents.doc_id LIMIT 5""",
    "rating_labels": f"WITH {_RATINGS} SELECT review_id, overall, label FROM ratings",
    "rating_labels_dirty": f"""WITH {_RATINGS},
dirty AS (
  SELECT review_id, CASE event_type WHEN 'error' THEN props WHEN 'signup' THEN 'NaN'
           WHEN 'view' THEN ' ' || CAST(CAST(overall AS INTEGER) AS VARCHAR)
           WHEN 'purchase' THEN CAST(overall AS VARCHAR) || 'e0' END AS rating_text
  FROM ratings),
parsed AS (SELECT *, TRY_CAST(trim(rating_text) AS DOUBLE) AS d FROM dirty)
SELECT review_id, rating_text, CASE WHEN d < 3 THEN 0 WHEN d = 3 THEN 1 ELSE 2 END AS label
FROM parsed WHERE d IS NOT NULL AND NOT isnan(d)""",
    "rating_summary": f"""WITH {_RATINGS}
SELECT count(overall) AS n, round(avg(overall), 6) AS mean, round(stddev_samp(overall), 6) AS std,
       min(overall) AS min, quantile_cont(overall, 0.25) AS q25, quantile_cont(overall, 0.5) AS q50,
       quantile_cont(overall, 0.75) AS q75, max(overall) AS max
FROM ratings""",
    "value_quartiles": """WITH measures AS (SELECT value + event_id / 3.0::DOUBLE AS m FROM events)
SELECT count(m) AS n, round(avg(m), 6) AS mean, round(stddev_samp(m), 6) AS std, round(min(m), 6) AS min,
       round(quantile_cont(m, 0.25), 6) AS q25, round(quantile_cont(m, 0.5), 6) AS q50,
       round(quantile_cont(m, 0.75), 6) AS q75, round(max(m), 6) AS max
FROM measures""",
    "rating_histogram": f"WITH {_RATINGS} SELECT overall, count(*) AS n FROM ratings GROUP BY overall",
    "null_profile": f"""WITH {_PREDICTIONS}
""" + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_missing FROM predictions"
        for c in ("review_id", "reviewer_id", "asin", "label", "predicted_label", "ingestion_time")
    ),
    "class_distribution": f"WITH {_RATINGS} SELECT label, count(*) AS n FROM ratings GROUP BY label",
    "class_weights": f"""WITH {_RATINGS}, counted AS (SELECT label, count(*) AS n FROM ratings GROUP BY label)
SELECT label, n, round(sum(n) OVER () / n, 6) AS weight FROM counted""",
    "weighted_rows": f"""WITH {_RATINGS}, counted AS (SELECT label, count(*) AS n FROM ratings GROUP BY label),
weights AS (SELECT label, round(sum(n) OVER () / n, 6) AS weight FROM counted)
SELECT review_id, label, weight FROM ratings JOIN weights USING (label)""",
    "rebalance_exact": f"""WITH {_RATINGS}, {_rebalanced('ratings', _KEEP_EXACT)}
SELECT review_id, label, copy FROM balanced""",
    "rebalance_hash": f"""WITH {_RATINGS}, {_rebalanced('ratings', _KEEP_HASH)}
SELECT review_id, label, copy FROM balanced""",
    "downsample_exact": f"""WITH {_LOPSIDED}, {_rebalanced('lopsided', _KEEP_EXACT)}
SELECT review_id, label, copy FROM balanced""",
    "rebalance_without_negatives": f"""WITH {_RATINGS},
upper AS (SELECT review_id, label FROM ratings WHERE label > 0), {_rebalanced('upper', _KEEP_EXACT)}
SELECT review_id, label, copy FROM balanced""",
    "downsample_hash": f"""WITH {_LOPSIDED}, {_rebalanced('lopsided', _KEEP_HASH)}
SELECT review_id, label, copy FROM balanced""",
    "shuffled_head": f"WITH {_RATINGS} SELECT review_id, label FROM ratings ORDER BY md5(review_id || ':42'), review_id LIMIT 100",
    "split_rows": f"WITH {_SPLIT_ROWS} SELECT review_id, label, split FROM split_rows",
    "split_sizes": f"WITH {_SPLIT_ROWS} SELECT split, count(*) AS n FROM split_rows GROUP BY split",
    "split_by_class": f"WITH {_SPLIT_ROWS} SELECT split, label, count(*) AS n FROM split_rows GROUP BY ALL",
    "training_rows": f"""WITH {_SPLIT_ROWS}, train AS (SELECT * FROM split_rows WHERE split = 'train'),
{_rebalanced('train', _KEEP_HASH)}
SELECT 'train' AS split, label, count(*) AS n FROM balanced GROUP BY label
UNION ALL
SELECT split, label, count(*) AS n FROM split_rows WHERE split <> 'train' GROUP BY ALL""",
    "training_mix": f"""WITH {_SPLIT_ROWS}, train AS (SELECT * FROM split_rows WHERE split = 'train'),
{_rebalanced('train', _KEEP_HASH)}
SELECT 'curated' AS rows, label, count(*) AS n FROM split_rows GROUP BY label
UNION ALL SELECT 'train', label, count(*) FROM balanced GROUP BY label
UNION ALL SELECT split, label, count(*) FROM split_rows WHERE split <> 'train' GROUP BY ALL""",
    "tokens": _listed("ws", "words"),
    "stopwords_removed": _listed("fs", "words"),
    "bigrams": _grams(2, "bigrams"),
    "trigrams": _grams(3, "trigrams"),
    "idf_terms": f"""WITH {_WORDS},
terms AS (SELECT DISTINCT doc_id, unnest(fs) AS term FROM words)
SELECT term, count(*) AS doc_freq,
       round(ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)), 6) AS idf
FROM terms GROUP BY term""",
    "vocab_tfidf": f"""WITH {_CLEANED_DOCS},
terms AS (SELECT doc_id, unnest(string_split(t, ' ')) AS term FROM cleaned),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE length(term) >= 2 GROUP BY ALL),
vocab AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) + 1 AS idf FROM tf
          GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 5000),
raw AS (SELECT doc_id, term, tf, tf * idf AS x FROM tf JOIN vocab USING (term))
SELECT doc_id, term, tf, round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM raw""",
    "hashed_features": f"""WITH {_HASHED}
SELECT doc_id, {", ".join(f"count(*) FILTER (space = {k}) AS n_{n}, "
                          f"coalesce(sum(bucket) FILTER (space = {k}), 0)::BIGINT AS {n}_sum, "
                          f"coalesce(sum(bucket * bucket) FILTER (space = {k}), 0)::BIGINT AS {n}_squares"
                          for k, n in enumerate(("words", "bigrams", "trigrams")))}
FROM terms JOIN buckets USING (term) GROUP BY doc_id""",
    "hashed_buckets": f"""WITH {_HASHED}
SELECT doc_id, CAST(bucket AS INTEGER) AS bucket, count(*) AS n FROM terms JOIN buckets USING (term) WHERE space = 0 GROUP BY ALL""",
    "label_index_freq": _label_index("n DESC, label"),
    "label_index_alpha": _label_index("label"),
    "confusion_matrix": f"WITH {_CONFUSION} SELECT * FROM confusion",
    "confusion_display": f"""WITH {_CONFUSION}
SELECT label, CAST(coalesce(sum(n) FILTER (prediction = 0), 0) AS BIGINT) AS predicted_negative,
       CAST(coalesce(sum(n) FILTER (prediction = 1), 0) AS BIGINT) AS predicted_neutral,
       CAST(coalesce(sum(n) FILTER (prediction = 2), 0) AS BIGINT) AS predicted_positive
FROM confusion GROUP BY label""",
    "prediction_distribution": f"""WITH {_PREDICTIONS}
SELECT predicted_label, count(*) AS n FROM predictions GROUP BY predicted_label""",
    "per_class_metrics": f"""WITH {_PER_CLASS}
SELECT class, actual, predicted, hits, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM per_class""",
    "overall_metrics": f"""WITH {_PER_CLASS}
SELECT round(sum(hits) / sum(actual), 6) AS accuracy,
       round(sum(precision * actual) / sum(actual), 6) AS weighted_precision,
       round(sum(recall * actual) / sum(actual), 6) AS weighted_recall,
       round(sum(f1 * actual) / sum(actual), 6) AS weighted_f1 FROM per_class""",
    "svm_scores": _HELD_OUT_ROWS,
    "logistic_scores": _HELD_OUT_ROWS,
    "forest_scores": _HELD_OUT_ROWS,
    "model_metrics": f"""WITH {_REVIEW_SPLIT}
SELECT split, CAST(label AS DOUBLE) AS class, count(*) AS actual, true AS agrees
FROM split_rows WHERE split <> 'train' GROUP BY split, label""",
    "grid_search": f"""WITH {_REVIEW_SPLIT}
SELECT CAST(unnest([0.01, 0.1]) AS DOUBLE) AS reg_param, count(*) FILTER (split = 'train') AS train_rows,
       true AS valid, true AS best_chosen
FROM split_rows""",
    "stream_scored": f"WITH {_REVIEWS} SELECT review_id, asin, true AS agrees FROM reviews",
    "json_roundtrip": f"""WITH {_REVIEWS}
SELECT review_id, reviewer_id, asin, review_time, overall, review_text FROM reviews""",
    "json_quarantine": _QUARANTINE,
    "ingest_stats": f"""WITH {_REVIEWS},
counted AS (SELECT count(*) AS total, count(*) FILTER (event_id % 50 NOT IN (0, 2)) AS sent,
                   count(*) FILTER (event_id % 50 = 0) AS errors, count(*) FILTER (event_id % 50 = 1) AS wrong_typed,
                   count(*) FILTER (event_id % 50 = 2) AS missing FROM reviews)
SELECT *, CAST({_percent('sent', 'total')} AS DOUBLE) AS success_pct FROM counted""",
    "published_lines": f"WITH {_REVIEWS} SELECT count(*) AS lines FROM reviews",
    "csv_roundtrip": f"""WITH {_REVIEWS}, texts AS (SELECT event_id AS doc_id, review_text AS text FROM reviews),
{_lemmas('texts')}
SELECT review_id, reviewer_id, asin, review_time, overall, t AS cleaned_text, lemmatized_text, label
FROM reviews JOIN lemmas ON doc_id = event_id""",
    "jsonl_roundtrip": f"""WITH {_REVIEWS}
SELECT review_id, reviewer_id, asin, overall, review_time, review_text FROM reviews""",
    "stream_stored": f"""WITH {_REVIEWS}, sent AS (SELECT *, event_id % 50 IN (0, 2) AS cut FROM reviews)
SELECT CASE WHEN NOT cut THEN review_id WHEN event_id % 50 = 0
         THEN md5(CASE WHEN review_text IS NULL THEN '{{"overall"' ELSE '{{"reviewTe' END) END AS review_id, CASE WHEN NOT cut THEN reviewer_id END AS reviewer_id,
       CASE WHEN NOT cut THEN asin END AS asin, CASE WHEN NOT cut THEN review_time END AS review_time,
       CASE WHEN cut THEN '' ELSE {_clean_stream('review_text')} END AS lemmatized_text,
       CASE WHEN NOT cut AND event_id % 50 <> 1 THEN label END AS predicted_label
FROM sent""",
    "stream_model_change": f"""WITH {_REVIEWS}, halves AS (SELECT *, CASE WHEN day(ts) <= 15 THEN 0 ELSE 1 END AS half FROM reviews)
SELECT review_id, CAST((length({_clean_stream('review_text')}) + half) % 3 AS INTEGER) AS predicted_label,
       CASE half WHEN 0 THEN 'first' ELSE 'second' END AS model
FROM halves""",
    "stream_generated_ids": f"""WITH {_REVIEWS}
SELECT count(*) AS stored, count(*) AS with_id, (SELECT count(*) FROM (
  SELECT DISTINCT review_text, overall, review_time, reviewer_id, asin FROM reviews)) AS ids FROM reviews""",
    "stream_quarantine": _QUARANTINE,
    "stream_batch_times": "SELECT count(*) AS stored, true AS one_time_each, true AS always_known, true AS rising FROM events",
    "stream_side_by_side": """WITH kinds AS (SELECT event_id % 50 AS kind FROM events)
SELECT unnest(['cleaned', 'lemmas']) AS query, count(*) FILTER (kind <> 2) AS stored,
       count(*) FILTER (kind > 2) AS scored, count(*) FILTER (kind NOT IN (0, 2)) + 2 AS reviews FROM kinds""",
    "ingest_rate": f"""WITH placed AS (
  SELECT event_id % 50 AS kind, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 6 HOUR * unnest([0, 1]) AS begun
  FROM events),
counted AS (
  SELECT begun, count(*) AS total, count(*) FILTER (kind NOT IN (0, 2)) AS sent, count(*) FILTER (kind = 0) AS errors,
         count(*) FILTER (kind = 1) AS wrong_typed, count(*) FILTER (kind = 2) AS missing
  FROM placed GROUP BY begun)
SELECT strftime(begun, '%Y-%m-%d %H:%M:%S') AS start, strftime(begun + INTERVAL 12 HOUR, '%Y-%m-%d %H:%M:%S') AS "end",
       total, sent, errors, wrong_typed, missing, round(sent / 720.0::DOUBLE, 6) AS per_minute,
       CAST({_percent('sent', 'total')} AS DOUBLE) AS success_pct
FROM counted""",
    "stream_trend": f"""WITH {_WAVES}
SELECT strftime(CAST(ingestion_time AS DATE), '%Y-%m-%d') AS day, {_TALLIES} FROM arrived
WHERE newest IS NULL OR CAST(ingestion_time AS DATE) + INTERVAL 1 DAY > newest - INTERVAL 1 DAY
GROUP BY CAST(ingestion_time AS DATE)""",
    "stream_late": f"""WITH {_WAVES}
SELECT review_id, predicted_label, CAST(ingestion_time AS DATE) AS day FROM arrived
WHERE ingestion_time < newest - INTERVAL 1 DAY""",
    "stream_late_trend": f"""WITH {_WAVES}
SELECT CAST(ingestion_time AS DATE) AS day, {_TALLIES},
       count(*) FILTER (ingestion_time < newest - INTERVAL 1 DAY) AS late,
       CAST(ingestion_time AS DATE) + INTERVAL 1 DAY <= (SELECT max(date_trunc('milliseconds', ingestion_time)) FROM arrived) - INTERVAL 1 DAY
         AS closed
FROM arrived GROUP BY CAST(ingestion_time AS DATE)""",
    "stream_mart_refresh": _TREND,
    "stream_mart_counts": _counts("label, sentiment, reviews, total"),
    "stream_mart_reviewers": _top("reviewer_id"),
    "stream_mart_products": _top("asin"),
    "stream_mart_recent": _recent(15, f", CASE WHEN length({_clean_stream('text')}) > 200"
                                  f" THEN left({_clean_stream('text')}, 200) || '...' ELSE {_clean_stream('text')} END AS lemmatized_text"),
    "stream_landed": f"""WITH {_PREDICTIONS}
SELECT review_id, reviewer_id, asin, strftime(ingestion_time, '%Y-%m-%d') AS review_time, predicted_label, text,
       {_clean_stream('text')} AS lemmatized_text, CAST(ingestion_time AS DATE) AS ingest_date
FROM predictions LEFT JOIN documents ON CAST(doc_id AS VARCHAR) = review_id""",
    "stream_mart_merged": f"""SELECT state, (SELECT count(*) FROM events) AS stored, label, reviews
FROM ({_counts("label, reviews")}), (SELECT unnest(['before', 'merged', 'replayed', 'vacuumed']) AS state)""",
    "stream_mart_stats": _STATS,
}
