"""The registered analyses as plain SQL (DuckDB dialect) over the driver
tables, used as an independent check of the Spark results.

Every SQL text here computes the same columns (same names) as the entry of
the same name in ``quillspark.plans.queries``; parameters come from there.
"""

from __future__ import annotations

from quillspark.plans import fixtures as FX
from quillspark.plans import queries as Q


def _s(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


# What a token is (see the README), written down a second time, character by character.
_L = r"(?:[^\P{L}\p{Han}\p{Hiragana}\p{Katakana}\x{30FC}\x{FF70}\x{3031}-\x{3035}]|\p{Nl})(?:\p{M}|[^\P{Cf}\x{200B}])*"
_N = r"[\p{Nd}\x{66B}](?:\p{M}|[^\P{Cf}\x{200B}])*"
_J = r"[\p{Pc}\x{202F}](?:\p{M}|[^\P{Cf}\x{200B}])*"
_ML = r"[.'\x{2018}\x{2019}\x{2024}\x{FE52}\x{FF07}\x{FF0E}\x{B7}\x{387}\x{55F}\x{5F4}\x{2027}\x{FE13}](?:\p{M}|[^\P{Cf}\x{200B}])*"
_MN = (r"[.'\x{2018}\x{2019}\x{2024}\x{FE52}\x{FF07}\x{FF0E},;\x{37E}\x{589}\x{60C}\x{60D}\x{66C}\x{7F8}\x{2044}\x{FE10}\x{FE14}\x{FE50}\x{FE54}\x{FF0C}\x{FF1B}]"
       r"(?:\p{M}|[^\P{Cf}\x{200B}])*")
_WORD = f"(?:{_L}(?:(?:{_ML})?{_L})*|{_N}(?:(?:{_MN})?{_N})*)"
_KANA = r"[\p{Katakana}\x{30FC}\x{FF70}\x{3031}-\x{3035}](?:[\p{Katakana}\x{30FC}\x{FF70}\x{3031}-\x{3035}]|\p{M}|[^\P{Cf}\x{200B}])*"
PAT = _s(f"(?:{_J})*{_WORD}(?:{_WORD}|{_J})*|(?:{_J})" + "{2,}" + f"|{_KANA}|" + r"[\p{Han}\p{Hiragana}](?:\p{M}|[^\P{Cf}\x{200B}])*")
STOP = f"(SELECT word FROM {FX.sql_values([(w,) for w in FX.STOP_WORDS], ['word'])})"
POLARITY = FX.sql_values([(w, "positive") for w in FX.POSITIVE] + [(w, "negative") for w in FX.NEGATIVE],
                         ["word", "sentiment"])
NEGPOS = FX.sql_values([(w, "pos") for w in FX.POSITIVE] + [(w, "neg") for w in FX.NEGATIVE],
                       ["word", "neg_pos"])
SCORES = FX.sql_values(list(FX.SCORES.items()), ["word", "score"])
CAST = FX.sql_values(FX.CAST, ["name", "gender", "speaker_clean", "nameshort"])
NAMES = FX.sql_values(FX.FIRST_NAMES, ["name", "year", "female", "male"])

DOC_LINES = """(SELECT doc_id, lang, source, CAST(i AS INTEGER) AS line_no, arr[i] AS line
 FROM (SELECT doc_id, lang, source, arr, unnest(generate_series(1, len(arr))) AS i
       FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS arr FROM documents)))"""

DOC_TOKENS = f"""(SELECT doc_id, lang, source, CAST(tpos AS INTEGER) AS tpos, word
 FROM (SELECT doc_id, lang, source, unnest(toks) AS word, unnest(generate_series(1, len(toks))) AS tpos
       FROM (SELECT doc_id, lang, source, regexp_extract_all(lower(text), {PAT}) AS toks FROM documents)))"""

LINE_TOKENS = f"""(SELECT doc_id, lang, source, line_no, CAST(tpos AS INTEGER) AS tpos, word
 FROM (SELECT doc_id, lang, source, line_no, unnest(toks) AS word, unnest(generate_series(1, len(toks))) AS tpos
       FROM (SELECT doc_id, lang, source, line_no, regexp_extract_all(lower(line), {PAT}) AS toks
             FROM {DOC_LINES})))"""

CONV_LINES = """(SELECT conv_id, turn, role, CAST(i AS INTEGER) AS line_no, arr[i] AS line
 FROM (SELECT conv_id, turn, role, arr, unnest(generate_series(1, len(arr))) AS i
       FROM (SELECT conv_id, turn, role, string_split(text, chr(10)) AS arr FROM conversations)))"""

CONV_TOKENS = f"""(SELECT conv_id, turn, role, line_no, unnest(regexp_extract_all(lower(line), {PAT})) AS word
 FROM {CONV_LINES})"""

NOT_STOP = f"word NOT IN {STOP}"

WORK_POS = f"""(SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, line_no, tpos)
        / count(*) OVER (PARTITION BY conv_id) AS word_position
 FROM (SELECT conv_id, turn, line_no, unnest(toks) AS word, CAST(unnest(generate_series(1, len(toks))) AS INTEGER) AS tpos
       FROM (SELECT conv_id, turn, line_no, regexp_extract_all(lower(line), {PAT}) AS toks FROM {CONV_LINES}))
 WHERE {NOT_STOP})"""

WORK_DECILES = f"""(SELECT ceil(word_position * 10) / 10 AS decile, word, count(*) AS n
 FROM {WORK_POS} GROUP BY 1, 2)"""

DOC_NB = f"""(SELECT doc_id, line_no, line, lag(line, 1) OVER w AS prev1, lag(line, 2) OVER w AS prev2,
        lead(line, 1) OVER w AS next1
 FROM {DOC_LINES} WINDOW w AS (PARTITION BY doc_id ORDER BY line_no))"""

CONV_W = "PARTITION BY conv_id ORDER BY turn, line_no"
UPTO = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _nd(col: str) -> str:
    """R's n_distinct (NULL counts as a value)."""
    return (f"CAST(count(DISTINCT {col}) + coalesce(max(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END), 0)"
            " AS BIGINT)")


def _tfidf(counts: str, term: str, doc: str) -> str:
    return f"""(SELECT c.*, c.n / dt.tot AS tf, ln(nd.nd / df.dfreq) AS idf,
        (c.n / dt.tot) * ln(nd.nd / df.dfreq) AS tf_idf
 FROM {counts} c
 JOIN (SELECT {doc}, sum(n) AS tot FROM {counts} GROUP BY {doc}) dt ON c.{doc} IS NOT DISTINCT FROM dt.{doc}
 JOIN (SELECT {term}, count(*) AS dfreq FROM {counts} GROUP BY {term}) df
      ON c.{term} IS NOT DISTINCT FROM df.{term}
 CROSS JOIN (SELECT {_nd(doc)} AS nd FROM {counts}) nd)"""


def _rel_pos() -> str:
    return f"""(SELECT doc_id, tpos, word,
        row_number() OVER (PARTITION BY doc_id ORDER BY tpos) / count(*) OVER (PARTITION BY doc_id)
          AS word_position
 FROM {DOC_TOKENS} WHERE {NOT_STOP})"""


DECILE_COUNTS = f"""(SELECT ceil(word_position * 10) / 10 AS decile, word, count(*) AS n
 FROM {_rel_pos()} GROUP BY 1, 2)"""

BRAND_MEMBERS = """(SELECT DISTINCT l.l_orderkey, p.p_brand FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""
BRAND_PAIRS = f"""(SELECT a.p_brand AS member_a, b.p_brand AS member_b, count(*) AS n
 FROM {BRAND_MEMBERS} a JOIN {BRAND_MEMBERS} b ON a.l_orderkey = b.l_orderkey AND a.p_brand <> b.p_brand
 GROUP BY 1, 2)"""

MARKED = f"""(SELECT conv_id, turn, line_no, CASE WHEN length(line) < {Q.MARK_LEN} THEN line END AS mark
 FROM {CONV_LINES})"""

DIALOGUE = f"""(SELECT conv_id, turn, role, line_no, line, rownumber, turnswitch,
        CAST(1 + coalesce(sum(CASE WHEN turnswitch = 'turnswitch' THEN 1 ELSE 0 END)
             OVER (PARTITION BY conv_id ORDER BY rownumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS BIGINT) AS dialrank
 FROM (SELECT *, CASE WHEN rownumber = nn THEN 'turnswitch'
                      WHEN NOT (rownumber = nn) THEN (CASE WHEN role <> nxt THEN 'turnswitch' END) END AS turnswitch
       FROM (SELECT conv_id, turn, role, line_no, line, row_number() OVER w AS rownumber,
                    count(*) OVER (PARTITION BY conv_id) AS nn, lead(role) OVER w AS nxt
             FROM {CONV_LINES} WINDOW w AS ({CONV_W}))))"""


def _lang_counts(lang: str, stop: bool) -> str:
    cond = f" AND {NOT_STOP}" if stop else ""
    return f"(SELECT word, count(*) AS n FROM {DOC_TOKENS} WHERE lang = {_s(lang)}{cond} GROUP BY word)"


def _blank(c: str) -> str:
    return f"(length({c}) < {Q.BLANK_LEN})"


def _fill(col: str, part: str, order: str) -> str:
    return f"last_value({col} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY {order} {UPTO}) AS {col}"


ANNOTATED = f"""(SELECT * FROM (
        SELECT doc_id, line_no, line, {_fill('akt', 'doc_id', 'line_no')}, {_fill('scene', 'doc_id', 'line_no')},
               {_fill('speaker', 'doc_id', 'line_no')}, {_fill('scene_description', 'doc_id', 'line_no')}
        FROM (SELECT doc_id, line_no, line, akt, scene, speaker,
                CASE WHEN (NOT {_blank('prev1')} AND {_blank('line')} AND {_blank('next1')}) THEN 'scene_descr_end'
                     WHEN NOT (NOT {_blank('prev1')} AND {_blank('line')} AND {_blank('next1')}) THEN sd1 END
                  AS scene_description
              FROM (SELECT *, CASE WHEN NOT {_blank('line')} AND {_blank('prev1')} AND {_blank('prev2')}
                                        AND scene IS NOT NULL THEN 'scene_descr_begin' END AS sd1
                    FROM (SELECT doc_id, line_no, line, prev1, prev2, next1,
                            CASE WHEN coalesce(regexp_matches(line, {_s(Q.ACT_PATTERN)}), false) THEN line END AS akt,
                            regexp_replace(CASE WHEN coalesce(contains(line, {_s(Q.SCENE_LITERAL)}), false)
                                                THEN line END, 'tion', 'TION') AS scene,
                            CASE WHEN NOT {_blank('line')} AND {_blank('prev1')} THEN line END AS speaker
                          FROM {DOC_NB}))))
        WHERE akt IS NOT NULL AND scene_description <> 'scene_descr_begin')"""

CATALOGUE = """(SELECT d.doc_id, d.lang AS language, b.quality = 1 AS has_text, b.toxic, d.source AS subject
 FROM documents d JOIN labels b ON d.doc_id = b.doc_id)"""


def _sel_base() -> str:
    return f"""(SELECT * FROM {CATALOGUE} WHERE regexp_matches(subject, '^src1') AND has_text
 AND language = 'en')"""


SQL: dict[str, str] = {
    "read_lines": f"SELECT doc_id, line_no, line FROM {DOC_LINES}",
    "attach_meta": f"SELECT l.doc_id, l.line_no, b.quality FROM {DOC_LINES} l JOIN labels b ON l.doc_id = b.doc_id",
    "filter_regex": f"SELECT doc_id, lang FROM documents WHERE regexp_matches(text, {_s(Q.REGEX)})",
    "filter_not_regex": f"SELECT doc_id, lang FROM documents WHERE NOT regexp_matches(text, {_s(Q.REGEX)})",
    "filter_eq": "SELECT doc_id, source FROM documents WHERE lang = 'de'",
    "filter_range": ("SELECT o_orderkey, o_totalprice FROM orders "
                     "WHERE o_totalprice > 100000 AND o_totalprice < 200000"),
    "having_count": f"SELECT word, count(*) AS n FROM {DOC_TOKENS} GROUP BY word HAVING count(*) > 50",
    "filter_null": ("SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels b ON d.doc_id = b.doc_id "
                    "WHERE b.quality IS NULL AND d.lang <> 'en'"),
    "project": "SELECT doc_id, lang, n_chars FROM documents",
    "rename_cols": "SELECT doc_id AS work_id, lang AS language, source FROM documents",
    "if_else_null": ("SELECT d.doc_id, CASE WHEN b.quality = 1 THEN 'good' WHEN NOT (b.quality = 1) THEN d.lang END"
                     " AS flag FROM documents d LEFT JOIN labels b ON d.doc_id = b.doc_id"),
    "nth_level": """WITH f AS (SELECT conv_id, role, min(turn) AS ft FROM conversations WHERE role IS NOT NULL
                              GROUP BY 1, 2),
                     r AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY ft) AS code FROM f)
                SELECT c.conv_id, c.turn, c.role FROM conversations c
                JOIN r ON c.conv_id = r.conv_id AND c.role = r.role WHERE r.code = 2""",
    "join_inner": ("SELECT d.doc_id, d.lang, b.quality, b.toxic FROM documents d "
                   "JOIN labels b ON d.doc_id = b.doc_id"),
    "join_inner_mapped": ("SELECT o.o_orderkey, c.c_name, c.c_mktsegment FROM orders o "
                          "JOIN customer c ON o.o_custkey = c.c_custkey"),
    "join_natural": f"""SELECT en.word, en.n AS n_en, de.n FROM {_lang_counts('en', False)} en
                        JOIN {_lang_counts('de', False)} de ON en.word = de.word""",
    "join_left": ("SELECT d.doc_id, b.quality, b.toxic FROM documents d "
                  "LEFT JOIN labels b ON d.doc_id = b.doc_id"),
    "stopword_anti": f"SELECT doc_id, tpos, word FROM {DOC_TOKENS} WHERE {NOT_STOP}",
    "category_minus": ("SELECT d.doc_id FROM documents d WHERE d.lang = 'en' AND NOT EXISTS "
                       "(SELECT 1 FROM labels b WHERE b.toxic = 1 AND b.doc_id = d.doc_id)"),
    "semi_in": ("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN "
                "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"),
    "count_by": "SELECT lang, count(*) AS n FROM documents GROUP BY lang",
    "count_sorted": f"SELECT word, count(*) AS n FROM {DOC_TOKENS} GROUP BY word ORDER BY n DESC, word",
    "count_grouped": f"SELECT source, word, count(*) AS n FROM {DOC_TOKENS} GROUP BY source, word",
    "weighted_mean": """SELECT l_returnflag,
        CAST(sum(CAST(l_discount AS DECIMAL(12,2)) * CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE)
        / CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS wmean
        FROM lineitem GROUP BY l_returnflag""",
    "n_distinct_by": f"SELECT event_type, {_nd('user_id')} AS n FROM events GROUP BY event_type",
    "distinct_and_rows": f"SELECT role, {_nd('conv_id')} AS n_distinct, count(*) AS n FROM conversations GROUP BY role",
    "share_of_total": f"""SELECT word, n, n / sum(n) OVER () AS share
        FROM (SELECT word, count(*) AS n FROM {DOC_TOKENS} WHERE {NOT_STOP} GROUP BY word)""",
    "distinct_rows": "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem",
    "drop_dupes": "SELECT DISTINCT text, lang FROM documents",
    "line_number": f"""SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS rn
        FROM {DOC_LINES} WHERE length(line) >= {Q.BLANK_LEN}""",
    "row_number_all": f"""SELECT conv_id, turn, line_no, row_number() OVER (ORDER BY conv_id, turn, line_no)
        AS rownumber FROM {CONV_LINES}""",
    "rel_position": f"SELECT doc_id, tpos, word_position FROM {_rel_pos()}",
    "decile_counts": f"SELECT decile, word, n FROM {DECILE_COUNTS}",
    "lag_lead": f"""SELECT conv_id, turn, line_no, row_number() OVER w AS rownumber, lag(line, 1) OVER w AS prev1,
        lag(line, 2) OVER w AS prev2, lead(line, 1) OVER w AS next1
        FROM {CONV_LINES} WINDOW w AS ({CONV_W})""",
    "fill_down": f"SELECT conv_id, turn, line_no, {_fill('mark', 'conv_id', 'turn, line_no')} FROM {MARKED}",
    "fill_up": f"""SELECT conv_id, turn, line_no, first_value(mark IGNORE NULLS) OVER ({CONV_W}
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS mark FROM {MARKED}""",
    "rank_marked": f"""SELECT conv_id, turn, line_no,
        CASE WHEN mark IS NOT NULL THEN CAST(sum(CASE WHEN mark IS NOT NULL THEN 1 ELSE 0 END)
             OVER ({CONV_W} {UPTO}) AS BIGINT) END AS rk FROM {MARKED}""",
    "sort_multi": ("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders "
                   "ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey"),
    "topk_ties_group": f"""SELECT lang, word, n FROM (
        SELECT lang, word, n, rank() OVER (PARTITION BY lang ORDER BY n DESC) AS rk
        FROM (SELECT lang, word, count(*) AS n FROM {DOC_TOKENS} GROUP BY lang, word)) WHERE rk <= {Q.TOP_K}""",
    "topk_ties": f"""SELECT word, n FROM (SELECT word, n, rank() OVER (ORDER BY n DESC) AS rk
        FROM (SELECT word, count(*) AS n FROM {DOC_TOKENS} WHERE {NOT_STOP} GROUP BY word))
        WHERE rk <= {Q.GLOBAL_TOP_K}""",
    "first_n": "SELECT doc_id FROM documents WHERE lang = 'de' ORDER BY doc_id LIMIT 15",
    "union_by_name": """SELECT c_custkey AS key, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS mktsegment
        FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
    "union_labelled": """SELECT 'customer' AS kind, c_custkey AS key, c_name AS name, c_acctbal AS acctbal
        FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier""",
    "pivot_fill": """SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
        count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
        FROM orders GROUP BY o_orderpriority""",
    "tokenize_count": f"SELECT lang, word, count(*) AS n FROM {DOC_TOKENS} GROUP BY lang, word",
    "graph_vertices": f"""SELECT DISTINCT name FROM (SELECT member_a AS name FROM {BRAND_PAIRS}
        UNION ALL SELECT member_b FROM {BRAND_PAIRS})""",
    "contains_literal": f"SELECT doc_id FROM documents WHERE contains(text, {_s(Q.LITERAL)})",
    "replace_first": f"""SELECT doc_id, line_no, regexp_replace(line, {_s(Q.REPLACE_PATTERN)}, 'TH') AS replaced
        FROM {DOC_LINES}""",
    "replace_all": f"""SELECT doc_id, line_no, regexp_replace(line, {_s(Q.REPLACE_PATTERN)}, 'TH', 'g') AS replaced
        FROM {DOC_LINES}""",
    "extract_regex": r"SELECT page_id, NULLIF(regexp_extract(url, '\?.*', 0), '') AS query FROM pages",
    "split_on_delim": """SELECT p_partkey,
        CASE WHEN instr(p_name, ' ') = 0 THEN p_name ELSE substr(p_name, 1, instr(p_name, ' ') - 1) END AS word,
        CASE WHEN instr(p_name, ' ') = 0 THEN p_name ELSE substr(p_name, instr(p_name, ' ') + 1) END AS kind
        FROM part""",
    "trim_ws": r"""SELECT doc_id, CAST(k AS INTEGER) AS k, regexp_replace(arr[k], '^\s+|\s+$', '', 'g') AS frag
        FROM (SELECT doc_id, arr, unnest(generate_series(1, len(arr))) AS k
              FROM (SELECT doc_id, string_split(text, '.') AS arr FROM documents))""",
    "concat_key": "SELECT n_name, concat_ws('.', n_regionkey, n_nationkey) AS key FROM nation",
    "bucket_lines": f"""SELECT doc_id, CAST(floor(line_no / {Q.ARC_WIDTH}) AS BIGINT) AS idx, count(*) AS n
        FROM {DOC_LINES} GROUP BY 1, 2""",
    "signed_counts": """SELECT l_returnflag, l_linestatus,
        CASE WHEN l_linestatus = 'F' THEN -count(*) WHEN NOT (l_linestatus = 'F') THEN count(*) END AS n
        FROM lineitem GROUP BY 1, 2""",
    "level_code": """SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY ft) AS code
        FROM (SELECT conv_id, role, min(turn) AS ft FROM conversations WHERE role IS NOT NULL GROUP BY 1, 2)""",
    "alpha_code": f"""SELECT word, dense_rank() OVER (ORDER BY word) AS code
        FROM (SELECT DISTINCT word FROM {DOC_TOKENS} WHERE word IS NOT NULL)""",
    "alpha_code_locale": f"""SELECT word, row_number() OVER (ORDER BY icu_sort_key(word, '{Q.LOCALE}'), word) AS code
        FROM (SELECT DISTINCT word FROM {DOC_TOKENS} WHERE word IS NOT NULL)""",
    "sort_locale": f"""SELECT doc_id, lang, NULLIF(regexp_extract(text, '^\\s*(\\S+)', 1), '') AS first FROM documents
        ORDER BY icu_sort_key(first, '{Q.LOCALE}') NULLS LAST, first, lang DESC NULLS LAST, doc_id""",
    "reorder_by_mean": """SELECT p_brand, CAST(sum(CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE)
        / count(p_retailprice) AS mean FROM part GROUP BY p_brand ORDER BY mean, p_brand""",
    "word_counts": f"""SELECT lang, word, count(*) AS n FROM {DOC_TOKENS} WHERE {NOT_STOP}
        GROUP BY lang, word ORDER BY n DESC, lang, word""",
    "compare_vocab": f"""SELECT word, a / sum(a) OVER () AS share_en, b / sum(b) OVER () AS share_de
        FROM (SELECT en.word, en.n AS a, de.n AS b FROM {_lang_counts('en', True)} en
              JOIN {_lang_counts('de', True)} de ON en.word = de.word)""",
    "tf_idf": f"""SELECT lang, word, n, tf, round(idf, {Q.LN_DIGITS}) AS idf, round(tf_idf, {Q.LN_DIGITS}) AS tf_idf FROM {_tfidf(
        f"(SELECT lang, word, count(*) AS n FROM {DOC_TOKENS} WHERE {NOT_STOP} GROUP BY lang, word)",
        'word', 'lang')}""",
    "sentiment_arc": f"""SELECT doc_id, "index", negative, positive, positive - negative AS sentiment FROM (
        SELECT t.doc_id, CAST(floor(t.line_no / {Q.ARC_WIDTH}) AS BIGINT) AS "index",
               count(*) FILTER (WHERE p.sentiment = 'negative') AS negative,
               count(*) FILTER (WHERE p.sentiment = 'positive') AS positive
        FROM {LINE_TOKENS} t JOIN {POLARITY} p ON t.word = p.word WHERE t.{NOT_STOP} GROUP BY 1, 2)""",
    "sentiment_signed": f"""SELECT t.doc_id, CAST(floor(t.line_no / {Q.ARC_WIDTH}) AS BIGINT) AS "index",
        p.sentiment, CASE WHEN p.sentiment = 'negative' THEN -count(*)
                          WHEN NOT (p.sentiment = 'negative') THEN count(*) END AS n
        FROM {LINE_TOKENS} t JOIN {POLARITY} p ON t.word = p.word WHERE t.{NOT_STOP} GROUP BY 1, 2, 3""",
    "sentiment_decile": f"""SELECT c.decile, sum(s.score * c.n) / sum(c.n) AS score
        FROM {DECILE_COUNTS} c JOIN {SCORES} s ON c.word = s.word GROUP BY c.decile""",
    "top_terms": f"""SELECT source, word, n, round(tf_idf, {Q.LN_DIGITS}) AS tf_idf FROM (
        SELECT *, rank() OVER (PARTITION BY source ORDER BY tf_idf DESC) AS rk FROM {_tfidf(
        f"(SELECT source, word, count(*) AS n FROM {DOC_TOKENS} WHERE {NOT_STOP} GROUP BY source, word)",
        'word', 'source')} WHERE n > {Q.MIN_N_TOP}) WHERE rk <= {Q.TOP_K}""",
    "tfidf_decile": f"""SELECT decile, word, n, round(tf_idf, {Q.LN_DIGITS}) AS tf_idf FROM (
        SELECT *, rank() OVER (ORDER BY tf_idf DESC) AS rk FROM {_tfidf(DECILE_COUNTS, 'word', 'decile')}
        WHERE n > {Q.MIN_N_DECILE}) WHERE rk <= {Q.TOP_K}""",
    "select_works": f"""SELECT doc_id, subject FROM {_sel_base()} s
        WHERE NOT EXISTS (SELECT 1 FROM {_sel_base()} m WHERE m.toxic = 1 AND m.doc_id = s.doc_id)""",
    "subject_counts": f"""SELECT subject, count(*) AS n FROM {CATALOGUE} WHERE has_text GROUP BY subject
        ORDER BY n DESC, subject""",
    "subject_counts_period": """SELECT s.o_orderpriority AS subject, count(*) AS n
        FROM (SELECT o.o_orderkey AS work_id FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
              WHERE c.c_name IN (SELECT c_name FROM customer WHERE c_nationkey < 15 AND c_nationkey > 5)) w
        LEFT JOIN orders s ON w.work_id = s.o_orderkey GROUP BY 1 ORDER BY n DESC, subject""",
    "cooccurrence": f"SELECT member_a, member_b, n FROM {BRAND_PAIRS}",
    "cooccurrence_share": f"""SELECT pr.member_a, pr.member_b, pr.n, t.n_a, pr.n / t.n_a AS share
        FROM {BRAND_PAIRS} pr LEFT JOIN (SELECT p_brand, count(*) AS n_a FROM {BRAND_MEMBERS} GROUP BY p_brand) t
        ON pr.member_a = t.p_brand WHERE pr.n / t.n_a > {Q.MIN_SHARE}""",
    "segment_trim": f"""SELECT doc_id, line_no, is_book FROM (
        SELECT doc_id, line_no, {_fill('is_book', 'doc_id', 'line_no')} FROM (
          SELECT doc_id, line_no,
            CASE WHEN regexp_matches(line, {_s(Q.SEGMENT_END)}) THEN 'nobook'
                 WHEN NOT regexp_matches(line, {_s(Q.SEGMENT_END)})
                 THEN (CASE WHEN regexp_matches(prev1, {_s(Q.SEGMENT_START)}) THEN 'book' END) END AS is_book
          FROM {DOC_NB})) WHERE is_book = 'book'""",
    "front_matter": f"""SELECT doc_id, line_no, line FROM (
        SELECT doc_id, line_no, line, {_fill('is_text', 'doc_id', 'line_no')} FROM (
          SELECT doc_id, line_no, line, CASE WHEN {_blank('next1')} THEN 'text' END AS is_text FROM {DOC_NB}))
        WHERE is_text IS NULL""",
    "annotate_structure": f"""SELECT doc_id, line_no, akt, scene, speaker, scene_description FROM {ANNOTATED}""",
    "play_network": rf"""WITH d AS (
          SELECT doc_id, akt, scene,
                 regexp_replace(regexp_replace(speaker, '\(.*', ''), '^\s+|\s+$', '', 'g') AS speaker_clean,
                 CASE WHEN line = speaker THEN '' WHEN NOT (line = speaker) THEN line END AS line2
          FROM {ANNOTATED}),
        m AS (SELECT DISTINCT doc_id, akt, scene, speaker_clean FROM d
              WHERE NOT regexp_matches(speaker_clean, 'Akt') AND NOT regexp_matches(speaker_clean, 'Scene')
                AND NOT (line2 = '') AND speaker_clean IS NOT NULL)
        SELECT a.speaker_clean AS member_a, b.speaker_clean AS member_b, count(*) AS n
        FROM m a JOIN m b ON a.doc_id IS NOT DISTINCT FROM b.doc_id AND a.akt IS NOT DISTINCT FROM b.akt
             AND a.scene IS NOT DISTINCT FROM b.scene AND a.speaker_clean <> b.speaker_clean
        GROUP BY 1, 2""",
    "clean_speakers": rf"""SELECT conv_id, turn, line_no, speaker_clean, activity, nameshort, gender FROM (
        SELECT s.*, c.nameshort, c.gender,
               CASE WHEN s.line = s.speaker THEN '' WHEN NOT (s.line = s.speaker) THEN s.line END AS line2
        FROM (SELECT conv_id, turn, line_no, line, role AS speaker,
                NULLIF(regexp_extract(role, '\(.*', 0), '') AS activity,
                regexp_replace(regexp_replace(regexp_replace(role, '\(.*', ''), '^\s+|\s+$', '', 'g'),
                               '^(?:system)$', 'narrator') AS speaker_clean
              FROM {CONV_LINES}) s
        LEFT JOIN {CAST} c ON s.speaker_clean IS NOT DISTINCT FROM c.speaker_clean)
        WHERE NOT regexp_matches(speaker_clean, 'Akt') AND NOT regexp_matches(speaker_clean, 'Scene')
          AND NOT (line2 = '')""",
    "name_profile": rf"""SELECT g.gender, count(*) AS n
        FROM (SELECT NULLIF(regexp_extract(regexp_replace(p_name, '^([^,]+),\s*(.*)$', '\2 \1'), '^\s*(\S+)', 1), '')
                     AS first_name
              FROM part WHERE p_size < 40 AND p_size > 10) a
        LEFT JOIN (SELECT DISTINCT name, CASE WHEN sum(female) > sum(male) THEN 'female' ELSE 'male' END AS gender
                   FROM {NAMES} WHERE year BETWEEN {FX.NAME_YEARS[0]} AND {FX.NAME_YEARS[1]} GROUP BY name) g
        ON a.first_name IS NOT DISTINCT FROM g.name GROUP BY g.gender""",
    "number_turns": f"SELECT conv_id, turn, line_no, rownumber, turnswitch, dialrank FROM {DIALOGUE}",
    "turns_per_role": f"""SELECT role, {_nd('turn_key')} AS n
        FROM (SELECT role, concat_ws('.', conv_id, dialrank) AS turn_key FROM {DIALOGUE}) GROUP BY role""",
    "roles_per_conv": f"SELECT conv_id, {_nd('role')} AS n FROM {DIALOGUE} GROUP BY conv_id",
    "lines_per_role": f"""SELECT conv_id, role, {_nd('dialrank')} AS n_turns, count(*) AS n FROM {DIALOGUE}
        GROUP BY conv_id, role""",
    "scene_sizes": f"""SELECT d.conv_id, c.nameshort, c.gender, {_nd('d.dialrank')} AS n_turns, count(*) AS n
        FROM {DIALOGUE} d LEFT JOIN {CAST} c ON d.role IS NOT DISTINCT FROM c.speaker_clean
        WHERE c.gender IS NOT NULL GROUP BY d.conv_id, c.nameshort, c.gender""",
    "words_per_role": f"""SELECT c.conv_id, c.role, c.n, fc.scene_code, fr.role_code,
               concat_ws('.', fc.scene_code, fr.role_code) AS label
        FROM (SELECT conv_id, role, count(*) AS n FROM {CONV_TOKENS} GROUP BY conv_id, role) c
        LEFT JOIN (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS scene_code
                   FROM (SELECT DISTINCT conv_id FROM {CONV_LINES} WHERE conv_id IS NOT NULL)) fc
               ON c.conv_id = fc.conv_id
        LEFT JOIN (SELECT role, row_number() OVER (ORDER BY f) AS role_code
                   FROM (SELECT role, min(rn) AS f FROM (SELECT role, row_number() OVER
                           (ORDER BY conv_id, turn, line_no) AS rn FROM {CONV_LINES})
                         WHERE role IS NOT NULL GROUP BY role)) fr
               ON c.role = fr.role""",
    "build_lexicon": f"""WITH p AS (SELECT replace(p_name, ' ', '|') AS wp, p_retailprice AS Wert,
                        concat_ws(',', lower(p_type), lower(p_brand)) AS infl, p_size FROM part),
        s AS (SELECT 'neg' AS neg_pos, wp, Wert, infl FROM p WHERE p_size < 25
              UNION ALL SELECT 'pos', wp, Wert, infl FROM p WHERE p_size >= 25),
        w AS (SELECT neg_pos, Wert, CASE WHEN instr(wp, '|') = 0 THEN wp ELSE substr(wp, 1, instr(wp, '|') - 1) END
                     AS Wort, infl FROM s)
        SELECT neg_pos, Wert, word FROM (SELECT DISTINCT * FROM (
            SELECT neg_pos, Wert, unnest(regexp_extract_all(lower(Wort), {PAT})) AS word FROM w))
        UNION ALL
        SELECT neg_pos, Wert, word FROM (SELECT neg_pos, Wert, unnest(regexp_extract_all(lower(infl), {PAT})) AS word
                                         FROM w)""",
    "sentiment_by_conv": f"""SELECT conv_id, neg, pos, pos - neg AS sentiment FROM (
        SELECT t.conv_id, count(*) FILTER (WHERE p.neg_pos = 'neg') AS neg,
               count(*) FILTER (WHERE p.neg_pos = 'pos') AS pos
        FROM {CONV_TOKENS} t JOIN {NEGPOS} p ON t.word = p.word WHERE t.{NOT_STOP} GROUP BY t.conv_id)
        ORDER BY sentiment, conv_id""",
    "sentiment_by_conv_ordered": f"""SELECT s.*, fc.scene_code FROM (
        SELECT conv_id, neg, pos, pos - neg AS sentiment FROM (
          SELECT t.conv_id, count(*) FILTER (WHERE p.neg_pos = 'neg') AS neg,
                 count(*) FILTER (WHERE p.neg_pos = 'pos') AS pos
          FROM {CONV_TOKENS} t JOIN {NEGPOS} p ON t.word = p.word WHERE t.{NOT_STOP} GROUP BY t.conv_id)) s
        LEFT JOIN (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS scene_code
                   FROM (SELECT DISTINCT conv_id FROM {CONV_LINES} WHERE conv_id IS NOT NULL)) fc
        ON s.conv_id = fc.conv_id ORDER BY fc.scene_code""",
    "scene_at": f"""SELECT conv_id, turn, line_no, line FROM {CONV_LINES}
        WHERE conv_id = (SELECT conv_id FROM (SELECT DISTINCT conv_id FROM {CONV_LINES} WHERE conv_id IS NOT NULL)
                         ORDER BY conv_id LIMIT 1 OFFSET 4)""",
    "stop_table_counts": f"""SELECT lang, word, count(*) AS n FROM {DOC_TOKENS} t WHERE NOT EXISTS (
        SELECT 1 FROM (SELECT unnest(regexp_extract_all(lower(text), {PAT})) AS w FROM benchmark) b WHERE b.w = t.word)
        GROUP BY lang, word""",
    "rel_position_works": f"SELECT conv_id, turn, line_no, tpos, word, word_position FROM {WORK_POS}",
    "sentiment_decile_works": f"""SELECT c.decile, sum(s.score * c.n) / sum(c.n) AS score
        FROM {WORK_DECILES} c JOIN {SCORES} s ON c.word = s.word GROUP BY c.decile""",
    "tfidf_decile_works": f"""SELECT decile, word, n, round(tf_idf, {Q.LN_DIGITS}) AS tf_idf FROM (
        SELECT *, rank() OVER (ORDER BY tf_idf DESC) AS rk FROM {_tfidf(WORK_DECILES, 'word', 'decile')}
        WHERE n > {Q.MIN_N_DECILE}) WHERE rk <= {Q.TOP_K}""",
    "compare_tables": f"""SELECT word, a / sum(a) OVER () AS share_conv, b / sum(b) OVER () AS share_items FROM (
        SELECT x.word, x.n AS a, y.n AS b
        FROM (SELECT word, count(*) AS n FROM {CONV_TOKENS} WHERE {NOT_STOP} GROUP BY word) x
        JOIN (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), {PAT})) AS word FROM benchmark)
              WHERE {NOT_STOP} GROUP BY word) y ON x.word = y.word)""",
    "select_works_author": "SELECT p_partkey AS work_id, p_name AS author FROM part WHERE p_size > 10"
        + "".join(f" AND regexp_matches(p_name, {_s(p)})" for p in Q.AUTHOR_PATTERNS),
    "body_lines": f"""SELECT doc_id, line_no, line FROM (
        SELECT doc_id, line_no, line, {_fill('is_text', 'doc_id', 'line_no')} FROM (
          SELECT doc_id, line_no, line, CASE WHEN {_blank('next1')} THEN 'text' END AS is_text FROM {DOC_NB}))
        WHERE is_text = 'text'""",
    "scene_pick": f"""WITH d AS (SELECT doc_id, line_no, line, akt, scene FROM {ANNOTATED}),
        a AS (SELECT doc_id, akt, row_number() OVER (PARTITION BY doc_id ORDER BY min(line_no)) AS k FROM d WHERE akt IS NOT NULL GROUP BY 1, 2),
        s AS (SELECT doc_id, scene, row_number() OVER (PARTITION BY doc_id ORDER BY min(line_no)) AS k FROM d WHERE scene IS NOT NULL GROUP BY 1, 2)
        SELECT d.* FROM d JOIN a ON a.doc_id = d.doc_id AND a.akt = d.akt AND a.k = 2
        JOIN s ON s.doc_id = d.doc_id AND s.scene = d.scene AND s.k = 2""",
    "words_per_scene": f"""WITH d AS (SELECT doc_id, line_no, line, akt, scene, row_number() OVER (ORDER BY doc_id, line_no) AS rn FROM {ANNOTATED}),
        a AS (SELECT akt, row_number() OVER (ORDER BY min(rn)) AS act_code FROM d WHERE akt IS NOT NULL GROUP BY akt),
        s AS (SELECT scene, row_number() OVER (ORDER BY min(rn)) AS scene_code FROM d WHERE scene IS NOT NULL GROUP BY scene),
        c AS (SELECT akt, scene, CAST(sum(len(regexp_extract_all(lower(line), {PAT}))) AS BIGINT) AS n FROM d GROUP BY akt, scene)
        SELECT c.akt, c.scene, c.n, a.act_code, s.scene_code,
               concat(coalesce(CAST(a.act_code AS VARCHAR), 'NA'), '.', coalesce(CAST(s.scene_code AS VARCHAR), 'NA')) AS label
        FROM c LEFT JOIN a ON a.akt = c.akt LEFT JOIN s ON s.scene = c.scene WHERE c.n > 0""",
    "speakers_per_scene": f"SELECT doc_id, akt, scene, {_nd('speaker')} AS n FROM {ANNOTATED} GROUP BY doc_id, akt, scene",
    "lines_per_scene": f"""WITH d AS (SELECT doc_id, akt, scene, speaker, line_no, row_number() OVER w AS rn, count(*) OVER (PARTITION BY doc_id) AS nn,
                 lead(speaker) OVER w AS nxt FROM {ANNOTATED} WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
        t AS (SELECT *, 1 + coalesce(sum(CASE WHEN speaker <> nxt THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY rn
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS dialrank FROM d)
        SELECT doc_id, akt, scene, speaker, {_nd('dialrank')} AS n_turns, count(*) AS n FROM t GROUP BY doc_id, akt, scene, speaker""",
    "first_seen_source": """SELECT source, row_number() OVER (ORDER BY min(doc_id)) AS code FROM documents
        WHERE source IS NOT NULL GROUP BY source""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


__all__ = ["SQL", "oracle_sql"]
