"""DuckDB statements that compute each query on their own way.

They derive everything from the tables: positions by numbering rows, neighbours
by a self-join on position, top words and document frequencies in common table
expressions.  Nothing computed by Spark and no code of the package enters.
"""

from __future__ import annotations

# Short list shared with the Spark side: frequent words of the test corpus.
STOPWORDS = ("and", "are", "das", "der", "des", "die", "for", "les", "que", "that", "the", "und", "was", "with")
TOP_WORDS = 50
TOP_TERMS = 100
MANY_WORDS = 20_000
#: The vocabulary of rare words: these ranks by frequency.
RARE_RANKS = (400, 900)
N_DOCS = 10_000
MAX_LINE = 120

_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)

LINES = r"""
lines AS (
  SELECT doc_id, unnest(parts) AS text, generate_subscripts(parts, 1) - 1 AS line_no
  FROM (SELECT doc_id,
               string_split_regex(regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n') AS parts
        FROM documents WHERE text <> '')
)"""

_TOKENS = """
pieces AS (
  SELECT doc_id, line_no, unnest(parts) AS word, generate_subscripts(parts, 1) AS place
  FROM (SELECT doc_id, line_no, string_split_regex({folded}, '[^a-z]+') AS parts FROM {source})
),
tok AS (
  SELECT doc_id, line_no, word, row_number() OVER (PARTITION BY doc_id, line_no ORDER BY place) - 1 AS pos
  FROM pieces WHERE length(word) > 2 {where}
)"""


def _tok(grain: str = "doc", *, stop: bool = True, folded: bool = True) -> str:
    source = "(SELECT doc_id, 0 AS line_no, text FROM documents)" if grain == "doc" else "lines"
    body = _TOKENS.format(
        folded="lower(text)" if folded else "text",
        source=source,
        where=f"AND word NOT IN ({_STOP})" if stop else "",
    )
    return body if grain == "doc" else LINES + "," + body


TOP = f"""
top AS (
  SELECT word, count(*) AS n FROM tok GROUP BY word ORDER BY n DESC, word DESC LIMIT {TOP_WORDS}
)"""

# the words of the vocabulary, numbered anew inside each record
SEQ = """
seq AS (
  SELECT doc_id, line_no, word, row_number() OVER (PARTITION BY doc_id, line_no ORDER BY pos) - 1 AS pos
  FROM tok WHERE word IN (SELECT word FROM top)
)"""


def _near(d: int) -> str:
    return f"""
near AS (
  SELECT a.doc_id, a.line_no, a.word AS l, b.word AS r, abs(a.pos - b.pos) AS lag
  FROM (SELECT *, unnest([{', '.join(str(k) for k in range(-d, d + 1) if k)}]) AS step FROM seq) a
  JOIN seq b ON a.doc_id = b.doc_id AND a.line_no = b.line_no AND b.pos = a.pos + a.step
)"""


def _matrix(d: int, grain: str = "doc") -> str:
    return ",".join([_tok(grain), TOP, SEQ, _near(d)])


_CELL = "string_agg(r || ':' || n, ', ' ORDER BY r)"

# a vowel run and a consonant run; a leading y is written Y, so it counts as a consonant
_V, _C = "[aeiouy][aeiou]*", "[^aeiou][^aeiouy]*"


def _m(stem: str) -> str:
    return f"len(regexp_extract_all({stem}, '{_V}{_C}'))"


def _vowel(stem: str) -> str:
    return f"regexp_matches({stem}, '[aeiouy]')"


def _cvc(stem: str) -> str:
    return f"regexp_matches({stem}, '^{_C}[aeiouy][^aeiouwxy]$')"


def _rules(text: str, condition: str) -> str:
    """CASE over ``suffix>replacement`` rules, longest suffix first."""
    rules = [(r.split(">") + [""])[:2] for r in text.split()]
    cases = []
    for old, new in sorted(rules, key=lambda r: -len(r[0])):
        head = f"w[:-{len(old) + 1}]"
        cases.append(
            f"WHEN suffix(w, '{old}') THEN CASE WHEN {condition.format(m=_m(head))}"
            f"{f" AND regexp_matches({head}, '[st]$')" if old == 'ion' else ''} "
            f"THEN {head} || '{new}' ELSE w END"
        )
    return "CASE " + "\n".join(cases) + " ELSE w END"


_STEP_2 = """
ational>ate tional>tion enci>ence anci>ance izer>ize bli>ble alli>al entli>ent eli>e ousli>ous
ization>ize ation>ate ator>ate alism>al iveness>ive fulness>ful ousness>ous aliti>al iviti>ive
biliti>ble logi>log"""
_STEP_3 = "icate>ic ative alize>al iciti>ic ical>ic ful ness"
_STEP_4 = """
al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"""

STEMS = f"""
s0 AS (SELECT DISTINCT word, CASE WHEN word[1] = 'y' THEN 'Y' || word[2:] ELSE word END AS w FROM tok),
s1 AS (SELECT word, CASE
    WHEN suffix(w, 'sses') OR suffix(w, 'ies') THEN w[:-3]
    WHEN suffix(w, 's') AND NOT suffix(w, 'ss') THEN w[:-2] ELSE w END AS w FROM s0),
s2 AS (SELECT word, w, CASE
    WHEN suffix(w, 'eed') THEN NULL
    WHEN suffix(w, 'ed') AND {_vowel('w[:-3]')} THEN w[:-3]
    WHEN suffix(w, 'ing') AND {_vowel('w[:-4]')} THEN w[:-4] END AS cut FROM s1),
s3 AS (SELECT word, CASE
    WHEN suffix(w, 'eed') AND {_m('w[:-4]')} > 0 THEN w[:-2]
    WHEN cut IS NULL THEN w
    WHEN suffix(cut, 'at') OR suffix(cut, 'bl') OR suffix(cut, 'iz') THEN cut || 'e'
    WHEN cut[-1] = cut[-2] AND regexp_matches(cut, '[b-df-hj-km-np-rtv-x]$') THEN cut[:-2]
    WHEN suffix(cut, 'yy') AND regexp_matches(cut, '^({_C})?({_V}{_C})*yy$') THEN cut[:-2]
    WHEN {_m('cut')} = 1 AND {_cvc('cut')} THEN cut || 'e'
    ELSE cut END AS w FROM s2),
s4 AS (SELECT word, CASE WHEN suffix(w, 'y') AND {_vowel('w[:-2]')} THEN w[:-2] || 'i' ELSE w END AS w FROM s3),
s5 AS (SELECT word, {_rules(_STEP_2, '{m} > 0')} AS w FROM s4),
s6 AS (SELECT word, {_rules(_STEP_3, '{m} > 0')} AS w FROM s5),
s7 AS (SELECT word, {_rules(_STEP_4, '{m} > 1')} AS w FROM s6),
s8 AS (SELECT word, CASE WHEN suffix(w, 'e') AND ({_m('w[:-2]')} > 1
    OR ({_m('w[:-2]')} = 1 AND NOT {_cvc('w[:-2]')})) THEN w[:-2] ELSE w END AS w FROM s7),
stems AS (SELECT word, lower(CASE WHEN suffix(w, 'll') AND {_m('w')} > 1 THEN w[:-2] ELSE w END) AS stem FROM s8)"""

DF = """
df AS (
  SELECT stem AS term, count(*) AS df
  FROM (SELECT DISTINCT doc_id, line_no, stem FROM tok JOIN stems USING (word) WHERE stem <> '')
  GROUP BY stem
)"""
TOP_DF = f"""
top_df AS (SELECT term, df FROM df ORDER BY df DESC, term DESC LIMIT {TOP_TERMS})"""
TF = """
tf AS (
  SELECT doc_id, line_no, stem AS term, count(*) AS tf
  FROM tok JOIN stems USING (word) WHERE stem IN (SELECT term FROM top_df)
  GROUP BY doc_id, line_no, stem
)"""
SCORED = f"""
scored AS (
  SELECT doc_id, line_no, tf.term, tf * ln({N_DOCS}.0::DOUBLE / df + 1) AS score
  FROM tf JOIN top_df ON tf.term = top_df.term
)"""


def _df(grain: str = "doc") -> str:
    return ",".join([_tok(grain), STEMS, DF])


def _scored(grain: str = "doc") -> str:
    return ",".join([_df(grain), TOP_DF, TF, SCORED])


def _stripes(d: int) -> str:
    return f"""WITH {_matrix(d)},
cells AS (SELECT l, r, count(*) AS n FROM near GROUP BY l, r)
SELECT l AS word, '{{' || {_CELL} || '}}' AS stripe FROM cells GROUP BY l"""


def oracle_sql() -> dict[str, str]:
    pairs = {
        f"pairs_d{d}": f"WITH {_matrix(d)} SELECT l, r, count(*) AS n FROM near GROUP BY l, r"
        for d in (1, 2, 3, 4)
    }
    stripes = {f"stripes_d{d}": _stripes(d) for d in (1, 2, 3, 4)}
    by_record = "SELECT doc_id, l, r, count(*) AS n FROM near GROUP BY doc_id, l, r"
    doc_words = "SELECT doc_id, pos, word FROM"
    return {
        "doc_lines": f"WITH {LINES} SELECT doc_id, line_no::INT AS line_no, text FROM lines",
        "lines_max_len": f"""WITH {LINES},
ended AS (SELECT l.doc_id, l.line_no, l.text,
                 strlen(l.text) + CASE WHEN l.line_no < max(l.line_no) OVER (PARTITION BY l.doc_id)
                                         OR suffix(d.text, chr(10)) THEN 1 ELSE 0 END AS size
          FROM lines l JOIN documents d USING (doc_id))
SELECT doc_id, line_no::INT AS line_no, text
FROM ended WHERE size < {MAX_LINE}""",
        "docs_max_len": f"""WITH {LINES},
ended AS (SELECT l.doc_id, l.line_no, l.text,
                 strlen(l.text) + CASE WHEN l.line_no < max(l.line_no) OVER (PARTITION BY l.doc_id)
                                         OR suffix(d.text, chr(10)) THEN 1 ELSE 0 END AS size
          FROM lines l JOIN documents d USING (doc_id))
SELECT d.doc_id, coalesce(t.text, '') AS text FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(text || CASE WHEN size > strlen(text) THEN chr(10) ELSE '' END, '' ORDER BY line_no) AS text
  FROM ended WHERE size < {MAX_LINE} GROUP BY doc_id) t USING (doc_id)""",
        "word_list_trimmed": f"""WITH {LINES},
words AS (SELECT DISTINCT lower(regexp_replace(text, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')) AS word FROM lines)
SELECT word FROM words WHERE word <> ''""",
        "word_list_raw": f"WITH {LINES} SELECT DISTINCT text AS word FROM lines",
        "df_table": f"WITH {_df()} SELECT term, df FROM df",
        "df_lines": """WITH made AS (
  SELECT doc_id, regexp_extract(text, '\\w*') AS term,
         CASE WHEN lang = 'en' THEN n_chars::VARCHAR ELSE n_chars || '.0' END AS number
  FROM documents),
good AS (SELECT * FROM made WHERE number NOT LIKE '%.0' AND term <> '')
SELECT term, arg_max(number::BIGINT, doc_id) AS df FROM good GROUP BY term""",
        "doc_id_from_path": "SELECT doc_id::VARCHAR AS doc_id, length(text) AS n FROM documents",
        "tokens": f"WITH {_tok(stop=False)} {doc_words} tok",
        "tokens_case_sensitive": f"WITH {_tok(stop=False, folded=False)} {doc_words} tok",
        "tokens_no_stop": f"WITH {_tok()} {doc_words} tok",
        "top_sequence": f"WITH {_tok()}, {TOP}, {SEQ} {doc_words} seq",
        "word_count": f"WITH {_tok()} SELECT word, count(*) AS n FROM tok GROUP BY word",
        "word_count_all": f"WITH {_tok(stop=False)} SELECT word, count(*) AS n FROM tok GROUP BY word",
        "word_count_case_sensitive": f"""WITH {_tok(folded=False)}
SELECT word, count(*) AS n FROM tok GROUP BY word""",
        "top_words": f"WITH {_tok()}, {TOP} SELECT word, n FROM top",
        "top_words_names": f"WITH {_tok()}, {TOP} SELECT word FROM top",
        **pairs,
        "pairs_line_d2": f"WITH {_matrix(2, 'line')} SELECT l, r, count(*) AS n FROM near GROUP BY l, r",
        "pairs_sweep": f"""WITH {_matrix(4)}
SELECT d, l, r, count(*) AS n FROM near JOIN (SELECT unnest([1, 2, 3, 4])::BIGINT AS d) ON lag <= d
GROUP BY d, l, r""",
        "pairs_by_record_d2": f"WITH {_matrix(2)} {by_record}",
        "pairs_rollup_d2": f"""WITH {_matrix(2)}, by_record AS ({by_record})
SELECT l, r, sum(n)::BIGINT AS n FROM by_record GROUP BY l, r""",
        "pairs_text": f"""WITH {_matrix(1)}
SELECT '(' || l || ',' || r || ')' || chr(9) || count(*) AS line FROM near GROUP BY l, r""",
        "pairs_head": f"""WITH {_matrix(1)}
SELECT l, r, count(*) AS n FROM near GROUP BY l, r ORDER BY l, r LIMIT 20""",
        **stripes,
        "stripes_text": f"WITH s AS ({_stripes(2)}) SELECT word || chr(9) || stripe AS line FROM s",
        "stripes_by_record_d2": f"""WITH {_matrix(2)}, cells AS ({by_record}),
striped AS (SELECT doc_id, l AS word, '{{' || {_CELL} || '}}' AS stripe FROM cells GROUP BY doc_id, l)
SELECT DISTINCT seq.doc_id, seq.word, coalesce(stripe, '{{}}') AS stripe
FROM seq LEFT JOIN striped ON seq.doc_id = striped.doc_id AND seq.word = striped.word""",
        "stripes_keep_isolated_d1": f"""WITH {_matrix(1, 'line')},
cells AS (SELECT l, r, count(*) AS n FROM near GROUP BY l, r),
striped AS (SELECT l AS word, '{{' || {_CELL} || '}}' AS stripe FROM cells GROUP BY l)
SELECT DISTINCT seq.word, coalesce(stripe, '{{}}') AS stripe FROM seq LEFT JOIN striped USING (word)""",
        # a list too long for literals; some of its words never have a neighbour and show as {}
        "stripes_many_words_d1": f"""WITH {_tok('line')}, {TOP.replace(f'LIMIT {TOP_WORDS}', f'LIMIT {MANY_WORDS}')}, {SEQ}, {_near(1)},
cells AS (SELECT l, r, count(*) AS n FROM near GROUP BY l, r),
striped AS (SELECT l AS word, '{{' || {_CELL} || '}}' AS stripe FROM cells GROUP BY l)
SELECT DISTINCT seq.word, coalesce(stripe, '{{}}') AS stripe FROM seq LEFT JOIN striped USING (word)""",
        "stripes_merged_d2": _stripes(2),
        "stripes_to_pairs_d2": pairs["pairs_d2"],
        "stem_vocab": f"WITH {_tok(stop=False)}, {STEMS} SELECT word, stem FROM stems",
        "document_frequency": f"WITH {_df()} SELECT term, df FROM df",
        "document_frequency_line": f"WITH {_df('line')} SELECT term, df FROM df",
        "top_df": f"WITH {_df()}, {TOP_DF} SELECT term, df FROM top_df",
        "top_df_names": f"WITH {_df()}, {TOP_DF} SELECT term FROM top_df",
        "tf_known_terms": f"WITH {_scored()} SELECT doc_id, term, tf FROM tf",
        "tfidf": f"WITH {_scored()} SELECT doc_id, term, round(score, 4) AS score FROM scored",
        "tfidf_line": f"""WITH {_scored('line')}
SELECT doc_id, line_no::INT AS line_no, term, round(score, 4) AS score FROM scored""",
        "tfidf_text": f"""WITH {_scored()}
SELECT doc_id || chr(9) || term || chr(9) || printf('%.4f', score) AS line FROM scored""",
        "tokens_long_stop": f"""WITH {_tok(stop=False)},
often AS (SELECT word FROM tok GROUP BY word ORDER BY count(*) DESC, word DESC LIMIT {MANY_WORDS})
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos, word FROM tok ANTI JOIN often USING (word)""",
        "top_sequence_long": f"""WITH {_tok()}, {TOP.replace(f'LIMIT {TOP_WORDS}', f'LIMIT {MANY_WORDS}')}, {SEQ}
SELECT d.doc_id, count(s.word) AS n, coalesce(string_agg(s.word, ' ' ORDER BY s.pos), '') AS words
FROM documents d LEFT JOIN seq s USING (doc_id) GROUP BY d.doc_id""",
        "tfidf_all_terms": f"""WITH {_df()}, tf AS (
  SELECT doc_id, stem AS term, count(*) AS tf FROM tok JOIN stems USING (word) WHERE stem <> '' GROUP BY doc_id, stem)
SELECT doc_id, term, round(tf * ln({N_DOCS}.0::DOUBLE / df + 1), 4) AS score FROM tf JOIN df USING (term)""",
        "pairs_indexed_d2": pairs["pairs_d2"],
        "df_indexed": f"WITH {_df()} SELECT term, df FROM df",
        "tf_all_terms": f"""WITH {_df()}, tf AS (
  SELECT doc_id, stem AS term, count(*) AS tf FROM tok JOIN stems USING (word) WHERE stem <> '' GROUP BY doc_id, stem)
SELECT doc_id, term, tf FROM tf JOIN df USING (term)""",
        "tfidf_repeated_terms": f"WITH {_scored()} SELECT doc_id, term, round(score, 4) AS score FROM scored",
        "stripes_parts_d1": pairs["pairs_d1"],
        "stripes_sweep": f"""WITH {_matrix(4)},
cells AS (SELECT d, l, r, count(*) AS n FROM near JOIN (SELECT unnest([1, 2, 3, 4])::BIGINT AS d) ON lag <= d GROUP BY d, l, r)
SELECT d, l AS word, '{{' || {_CELL} || '}}' AS stripe FROM cells GROUP BY d, l""",
        "stripes_rare_isolated_d1": f"""WITH {_tok('line')}, ranked AS (
  SELECT word, row_number() OVER (ORDER BY count(*) DESC, word DESC) AS rank FROM tok GROUP BY word
), top AS (SELECT word FROM ranked WHERE rank > {RARE_RANKS[0]} AND rank <= {RARE_RANKS[1]}), {SEQ}, {_near(1)},
cells AS (SELECT l, r, count(*) AS n FROM near GROUP BY l, r),
striped AS (SELECT l AS word, '{{' || {_CELL} || '}}' AS stripe FROM cells GROUP BY l)
SELECT DISTINCT seq.word, coalesce(stripe, '{{}}') AS stripe FROM seq LEFT JOIN striped USING (word)""",
        "pairs_by_record_d500": f"WITH {_tok()}, {TOP}, {SEQ}, near AS (SELECT a.doc_id, a.word AS l, b.word AS r "
        "FROM seq a JOIN seq b ON a.doc_id = b.doc_id AND a.pos <> b.pos AND abs(a.pos - b.pos) <= 500) "
        "SELECT doc_id, l, r, count(*) AS n FROM near GROUP BY doc_id, l, r",
        "cooccurrence_plan": pairs["pairs_d2"],
        "result_counts": f"""WITH {_matrix(1)}, {STEMS}, {DF}, {TOP_DF}, {TF}
SELECT 'word_count' AS result, count(DISTINCT word) AS n_rows FROM tok
UNION ALL SELECT 'pairs', count(*) FROM (SELECT DISTINCT l, r FROM near)
UNION ALL SELECT 'document_frequency', count(*) FROM df
UNION ALL SELECT 'tfidf', count(*) FROM tf""",
    }
