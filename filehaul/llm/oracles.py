"""SQL of the queries that DuckDB can express."""

from __future__ import annotations

import string

from filehaul.llm.common import SPACES
from filehaul.llm.license_texts import NOTICES, PHRASES

WORDS, LONG_WORDS = f"[^{SPACES}]+", f"[^{SPACES}]{{2,}}"
MARKS = "[\\x21-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7E]|[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

TOKEN_COUNTS = f"""
    WITH counted AS (
        SELECT source, lang, coalesce(quality = 0, false) AS bad, coalesce(toxic = 1, false) AS toxic,
               len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS words,
               len(regexp_extract_all(coalesce(text, ''), '{LONG_WORDS}')) AS long_words,
               len(regexp_extract_all(coalesce(text, ''), '{MARKS}')) AS marks
        FROM documents LEFT JOIN labels USING (doc_id)
    )
    SELECT source, lang, 'words-1' AS tokenizer, count(*) AS docs,
           CAST(sum(CASE WHEN toxic THEN long_words ELSE words END) AS BIGINT) AS tokens
    FROM counted WHERE NOT bad GROUP BY source, lang
    UNION ALL
    SELECT source, lang, 'marks-1', count(*), CAST(sum(marks) AS BIGINT)
    FROM counted WHERE NOT bad GROUP BY source, lang
"""


def _words(text: str) -> str:
    lower = f"translate({text}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"list_filter(regexp_split_to_array({lower}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"


def license_scan() -> str:
    rows = [("phrase " + text, label, "true", text) for text, label in PHRASES.items()]
    rows += [("notice " + label, label, "false", text) for label, text in NOTICES.items()]
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    values = ",\n".join(f"({quoted(a)}, {quoted(b)}, {c}, {quoted(d)})" for a, b, c, d in rows)
    gram = "array_to_string(words[{at} + 1 : {at} + 3], ' ')"
    return f"""
    WITH docs AS (SELECT doc_id, {_words("coalesce(text, '')")} AS words FROM documents),
    templates AS (
        SELECT template, label, exact, {_words("text")} AS words
        FROM (VALUES {values}) AS t(template, label, exact, text)
    ),
    template_grams AS (
        SELECT template, label, exact, len(words) - 2 AS n_grams, tpos, {gram.format(at="tpos")} AS gram
        FROM (SELECT *, unnest(range(len(words) - 2)) AS tpos FROM templates)
    ),
    grams AS (
        SELECT doc_id, pos, {gram.format(at="pos")} AS gram
        FROM (SELECT *, unnest(range(greatest(len(words) - 2, 0))) AS pos FROM docs)
    ),
    votes AS (
        SELECT doc_id, template, label, exact, n_grams, tpos, pos, pos - tpos AS diagonal
        FROM grams JOIN template_grams USING (gram)
    ),
    places AS (
        SELECT doc_id, label, diagonal FROM votes WHERE exact
        GROUP BY doc_id, template, label, n_grams, diagonal HAVING count(*) = n_grams
    ),
    base AS (
        SELECT doc_id, count(*) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word,
               list(DISTINCT label) AS own
        FROM places GROUP BY doc_id
    ),
    stepped AS (
        SELECT *, CAST(coalesce(diagonal - lag(diagonal) OVER by_diagonal > 8, false) AS INTEGER) AS starts
        FROM votes WHERE NOT exact
        WINDOW by_diagonal AS (PARTITION BY doc_id, template ORDER BY diagonal, pos)
    ),
    merged AS (
        SELECT *, sum(starts) OVER (PARTITION BY doc_id, template ORDER BY diagonal, pos) AS span FROM stepped
    ),
    spans AS (
        SELECT a.doc_id, a.template, a.label, a.span, a.pos, count(DISTINCT b.tpos) / any_value(a.n_grams) AS cover
        FROM merged AS a JOIN merged AS b ON a.doc_id = b.doc_id AND a.template = b.template AND a.span = b.span
             AND b.pos >= a.pos AND b.pos + 3 - a.pos <= 1.5 * (a.n_grams + 2)
        GROUP BY a.doc_id, a.template, a.label, a.span, a.pos
    ),
    seen AS (
        SELECT doc_id, max(cover) AS cover, list(DISTINCT label) FILTER (cover >= 0.8) AS found
        FROM spans GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           array_to_string(list_sort(coalesce(own, [])), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(found, [])))), ',') AS labels,
           CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(cover, 0.0::DOUBLE) END AS score
    FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN seen USING (doc_id)
"""


def phrase_mining() -> str:
    lower = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lower}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
    ),
    split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(words)) AS HUGEINT) AS n FROM split GROUP BY lang),
    starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS spot FROM split),
    grams AS (
        SELECT lang, size, array_to_string(words[spot : spot + size - 1], ' ') AS phrase, count(*) AS a
        FROM (SELECT lang, words, spot, unnest(range(1, least(5, len(words) - spot + 1) + 1)) AS size FROM starts)
        GROUP BY ALL HAVING count(*) >= 100
    ),
    cuts AS (
        SELECT c.lang, c.phrase, c.a, f.a AS l, g.a AS r, n,
               1000::HUGEINT * c.a * n // (f.a::HUGEINT * g.a) AS score, k
        FROM (SELECT *, string_split(phrase, ' ') AS words, unnest(range(1, size)) AS k FROM grams WHERE size > 1) AS c
        JOIN totals USING (lang)
        JOIN grams AS f ON f.lang = c.lang AND f.phrase = array_to_string(c.words[1 : k], ' ')
        JOIN grams AS g ON g.lang = c.lang AND g.phrase = array_to_string(c.words[k + 1 :], ' ')
    ),
    lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inside AS (
        SELECT DISTINCT c.lang, c.phrase FROM grams AS c JOIN grams AS d
        ON d.lang = c.lang AND d.size > c.size AND 100 * d.a >= 100 * c.a AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ')
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase,
           a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM lowest ANTI JOIN inside USING (lang, phrase)
    QUALIFY rank <= 2000
    """
