"""DuckDB statements for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from review_pulse.llm import quality_rules as quality

_SPACES = r"[\x20\x09-\x0D]+"
_WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACES}'), lambda w: w <> '')"


def _quality() -> str:
    text = "coalesce(text, '')"
    classes = ", ".join(
        f"length({text}) - length(regexp_replace({text}, '[{c}]', '', 'g'))" for c in quality.CLASSES
    )
    fixed = ", ".join(
        f"('{n}', [{', '.join(repr(w) for w in words.split())}])" for n, words in quality.COMMON_WORDS.items())
    names = ", ".join(map(repr, quality.COMMON_WORDS))
    share = "list_transform({0}, lambda n: n * {1} // greatest(list_sum({0}), 1))".format
    width = len(quality.CLASSES) + 1
    sums = lambda name, n: "[" + ", ".join(f"sum({name}[{k}])::BIGINT" for k in range(1, n + 1)) + "]"
    normal = lambda h: f"CASE WHEN list_sum({h}) > 0 THEN list_transform({h}, lambda n: n / list_sum({h})) END"
    part = "CASE WHEN {0} > 0 THEN {0} * log2({0} / (({1} + {2}) / 2)) ELSE 0.0 END".format
    term = f"({part('z[1]', 'z[1]', 'z[2]')} + {part('z[2]', 'z[1]', 'z[2]')}) / 2"
    distance = lambda p, q: (
        f"CASE WHEN {p} IS NOT NULL AND {q} IS NOT NULL THEN sqrt(greatest(list_sum("
        f"list_transform(list_zip({p}, {q}), lambda z: {term})), 0.0)) END"
    )
    return f"""
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, lang, {text} AS text, {_WORDS} AS words, [{classes}] AS known,
    list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}]+'), lambda w: w <> '') AS letters,
    list_filter(string_split({text}, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), others AS (
  SELECT lang FROM texts WHERE lang IS NOT NULL AND lang NOT IN ({names})
  GROUP BY lang HAVING count(*) >= {quality.MIN_LIST_DOCS} ORDER BY count(*) DESC, lang LIMIT {quality.MAX_LISTS}
), own_words AS (
  SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(letters) AS word FROM texts JOIN others USING (lang)) GROUP BY ALL
), lists AS MATERIALIZED (
  SELECT * FROM (VALUES {fixed}) AS fixed(list_lang, list)
  UNION ALL
  SELECT o.lang, coalesce(list(word ORDER BY n DESC, word) FILTER (word IS NOT NULL), []) FROM others o LEFT JOIN (
    SELECT * FROM own_words QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {quality.LIST_WORDS}) w
    USING (lang) GROUP BY o.lang
), windows AS (
  SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM texts
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (
    PARTITION BY r, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, sum(least(3, coalesce(following - i, 3))) AS n FROM (
    SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS following FROM repeated) GROUP BY r
), counted AS (
  SELECT r, doc_id, lang, letters, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, length(text) AS n_chars_read,
    list_append(known, length(text) - list_sum(known)) AS class_counts
  FROM texts LEFT JOIN covered c USING (r)
), based AS MATERIALIZED (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {share('class_counts', quality.MILLION)} AS c,
    lang IN (SELECT list_lang FROM lists) AS listed
  FROM counted
), pairs AS MATERIALIZED (
  SELECT r, list_lang, listed AND lang IS NOT NULL AS is_own, base_failed, n_chars_read, n_words, c,
    {share('list_append(usual, n_letters - coalesce(list_sum(usual), 0))', quality.MILLION)} AS w
  FROM (SELECT *, list_transform(list, lambda w: len(list_filter(letters, lambda x: x = w))) AS usual, len(letters) AS n_letters
        FROM based JOIN lists ON lang = list_lang OR lang IS NULL OR NOT listed)
), reference AS (
  SELECT list_lang, {sums('c', width)} AS rc, list_filter({sums('w', quality.LIST_WORDS + 1)}, lambda n: n IS NOT NULL) AS rw
  FROM pairs WHERE is_own AND NOT base_failed GROUP BY list_lang
), normal AS (
  SELECT r, n_chars_read, n_words, {normal('c')} AS pc, {normal('w')} AS pw, {normal('rc')} AS qc, {normal('rw')} AS qw
  FROM pairs JOIN reference USING (list_lang)
), judged AS (
  SELECT r,
    round(min(CASE WHEN n_chars_read >= {quality.MIN_CHARS} THEN {distance('pc', 'qc')} END), 6) AS class_distance,
    round(min(CASE WHEN n_words >= {quality.MIN_WORDS} THEN {distance('pw', 'qw')} END), 6) AS word_distance
  FROM normal GROUP BY r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance,
  NOT base_failed AND coalesce(class_distance <= {quality.MAX_CLASS_DISTANCE}, true)
    AND coalesce(word_distance <= {quality.MAX_WORD_DISTANCE}, true) AS kept
FROM based LEFT JOIN judged USING (r)"""


_MIX = f"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size, left(md5(coalesce(doc_id::VARCHAR, '')), 16) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
    source_size * 2.0::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5 AS budget
  FROM sources
), filled AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked
), plan AS (
  SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, cap / weight) FROM filled
    WHERE level < cap / weight), cap / weight) * weight)::DOUBLE AS target
  FROM filled
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs,
    CASE WHEN source_size > 0 THEN floor(target)::BIGINT % source_size ELSE 0 END AS rest
  FROM plan
), placed AS (
  SELECT doc_id, size, source_size, target, epochs, rest, coalesce(sum(size) OVER (PARTITION BY sized.source
    ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done
  FROM sized JOIN budgets ON sized.source IS NOT DISTINCT FROM budgets.source
)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, rest - done)))::BIGINT AS taken
FROM placed"""


_DEDUP = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '{_SPACES}'), lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x
    JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN sizes p1 ON p1.doc_id = a JOIN sizes p2 ON p2.doc_id = b
  WHERE 100 * common >= 80 * (p1.n + p2.n - common)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), components AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)"""


_TOP = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
  FROM scored
)
SELECT * FROM ranked WHERE rank <= 20"""

_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
), digests AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(15 + 2 * length(role) - length(replace(replace(replace(role, chr(92), ''), '<', ''), chr(10), ''))
      + 2 * length(text) - length(replace(replace(text, chr(92), ''), '<', '')))::BIGINT AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars
FROM digests"""


def _crc_table() -> list[int]:
    table = []
    for k in range(256):
        for _ in range(8):
            k = k >> 1 ^ (0xEDB88320 if k & 1 else 0)
        table.append(k)
    return table


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SPELLING = f"""
WITH RECURSIVE table_of AS MATERIALIZED (SELECT {_crc_table()}::UBIGINT[] AS crc),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS spelled, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL
), checked AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(spelled, ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::UBIGINT] ELSE [195::UBIGINT, (128 + (ord(c) & 63))::UBIGINT] END))),
    lambda sum, byte: xor(sum >> 8, crc[(xor(sum, byte) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS h
  FROM runs, table_of
), counted AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word,
    sum(n)::BIGINT AS n
  FROM checked GROUP BY 1
), words AS MATERIALIZED (SELECT word, n FROM counted WHERE length(word) >= 7 AND n >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
skipped AS MATERIALIZED (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM places),
near AS (
  SELECT a.word, b.word AS other, b.n FROM skipped a JOIN skipped b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM skipped a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM skipped a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*)::BIGINT AS n_near, max(n) AS most FROM near GROUP BY word
), formed AS MATERIALIZED (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN most >= 10 * words.n THEN (
      SELECT min(other COLLATE "C") FROM near WHERE near.word = words.word AND near.n = most) END AS form,
    CASE WHEN most >= 10 * words.n THEN most END AS form_n
  FROM words LEFT JOIN best USING (word)
), followed AS (
  SELECT word, word AS root, form AS ahead FROM formed
  UNION ALL SELECT f.word, f.ahead, g.form FROM followed f JOIN formed g ON g.word = f.ahead
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM formed f JOIN followed r ON r.word = f.word AND r.ahead IS NULL"""

_DECONTAMINATION = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words FROM benchmark
), windows AS MATERIALIZED (
  SELECT DISTINCT item_id, size, array_to_string(words[k:k + size - 1], ' ') AS passage
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS k
        FROM (SELECT *, least(10, len(words)) AS size FROM items) WHERE size > 0)
), passages AS MATERIALIZED (
  SELECT r, k, size, array_to_string(words[k:k + size - 1], ' ') AS passage
  FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS k
        FROM texts, (SELECT DISTINCT size FROM windows))
), found AS MATERIALIZED (
  SELECT r, k, size, item_id FROM passages JOIN windows USING (size, passage)
), hit AS (
  SELECT r, count(DISTINCT place) AS n_hit
  FROM (SELECT DISTINCT r, unnest(range(k, k + size)) AS place FROM found) GROUP BY r
), listed AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
    array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS ids
  FROM found WHERE item_id IS NOT NULL GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)"""

_LEXICAL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words
  FROM documents
), sizes AS (
  SELECT count(*) FILTER (len(words) > 0) AS documents, sum(len(words))::BIGINT AS all_words FROM texts
), postings AS MATERIALIZED (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM texts) GROUP BY r, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * documents + 2) / (2 * df + 1)))::BIGINT AS weight
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), sizes
), queries AS (
  SELECT q, item_id, term, count(*) AS times
  FROM (SELECT row_number() OVER () AS q, item_id,
          unnest(regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term FROM benchmark)
  GROUP BY ALL
), scores AS (
  SELECT q, item_id, r, doc_id, sum(times * weight * ((1000000000 * tf)
    // (1000 * tf + 8 * (25 + (75 * len(words) * documents) // all_words))))::BIGINT AS score
  FROM queries JOIN weights USING (term) JOIN postings USING (term) JOIN texts USING (r), sizes
  GROUP BY q, item_id, r, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""


SQL = {
    "op2_quality_rules": _quality(),
    "op3_source_mix": _MIX,
    "op4_exact_topk": _TOP,
    "op7_minhash_dedup": _DEDUP,
    "op10_chat_format": _CHAT,
    "op11_spelling_variants": _SPELLING,
    "op12_decontamination": _DECONTAMINATION,
    "op13_lexical_search": _LEXICAL,
}
