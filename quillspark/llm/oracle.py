"""DuckDB SQL of the registered queries, where SQL can express them."""

from __future__ import annotations

from quillspark.llm import mixing, url_filter
from quillspark.llm.queries import RULES

WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _url() -> str:
    """Rules by CASE, ranks by 100 rounds of a recursive table (0.85**100 is below 1e-7)."""
    fits = lambda t: (f"((host = '{t.split('/', 1)[0]}' OR ends_with(host, '.{t.split('/', 1)[0]}')) "  # noqa: E731
                      f"AND starts_with(path, '/{t.split('/', 1)[1]}'))")
    longest = sorted(RULES, key=lambda r: -len(r[0]))
    rule = "CASE " + " ".join(f"WHEN {fits(t)} THEN '{t}'" for t, _ in longest) + " END"
    says = "CASE " + " ".join(f"WHEN {fits(t)} THEN '{v}'" for t, v in longest) + " END"
    d = url_filter.DAMPING
    return f"""WITH RECURSIVE cut AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        parsed AS (SELECT page_id, html, {LOWER.format("coalesce(regexp_extract(rest, '^([^/?#]*)', 1), '')")} AS host,
                   coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
        ruled AS (SELECT *, {rule} AS rule, {says} AS says FROM parsed),
        links AS (SELECT DISTINCT host AS src, {LOWER.format('dst')} AS dst FROM (
                  SELECT host, unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*["'']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''<>\\s]+)', 1)) AS dst FROM parsed WHERE host <> '')
                  WHERE host <> {LOWER.format('dst')}),
        two AS (SELECT 'allow' AS kind, src, dst FROM links UNION ALL SELECT 'block', dst, src FROM links),
        steps AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY kind, src) AS degree FROM two),
        counts AS (SELECT says AS kind, host, count(*) AS n FROM ruled WHERE says IS NOT NULL AND host <> '' GROUP BY says, host),
        seeds AS MATERIALIZED (SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS seed FROM counts),
        r AS (SELECT 0 AS n, kind, host, seed AS rank FROM seeds UNION ALL
              SELECT n + 1, kind, host, sum(rank) FROM (
                  SELECT r.n, r.kind, s.dst AS host, r.rank * ({d} / s.degree) AS rank FROM r JOIN steps s ON s.kind = r.kind AND s.src = r.host WHERE r.n < 100
                  UNION ALL SELECT k.n, e.kind, e.host, e.seed * (1 - {d}) FROM seeds e, (SELECT DISTINCT n FROM r WHERE n < 100) k) GROUP BY n, kind, host),
        hosts AS (SELECT host, sum(CASE WHEN kind = 'allow' THEN rank ELSE 0 END) AS trust, sum(CASE WHEN kind = 'block' THEN rank ELSE 0 END) AS distrust
                  FROM r WHERE n = 100 GROUP BY host),
        bad AS (SELECT host FROM hosts WHERE trust < {url_filter.THRESHOLD!r} * (trust + distrust))
        SELECT page_id, host, path, rule, coalesce(says, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict FROM ruled"""


def _ngram() -> str:
    return f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
              ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
        link AS (SELECT u, v FROM shared JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 85 * (x.n + y.n - k)),
        edge AS (SELECT u, v FROM link UNION SELECT v, u FROM link),
        reach AS (SELECT DISTINCT u AS a, u AS b FROM edge UNION SELECT r.a, e.v FROM reach r JOIN edge e ON e.u = r.b),
        comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
        SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(comp.c, w.doc_id) AS component_id
        FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN comp ON comp.a = w.doc_id"""


def _mix() -> str:
    """One running sum per source in the order of permuted blocks and documents.
    The shards of the splitting tree are random draws and not expressed."""
    seed, weights = mixing.SEED, mixing.WEIGHTS
    pick = "CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {} {} END".format(
        len(weights), " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(weights)))
    return f"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
        src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs FROM d GROUP BY source),
        w AS (SELECT *, {pick} AS weight FROM src),
        f AS (SELECT *, CAST(source_size * {mixing.CAP} AS DOUBLE) / weight AS full_at FROM w),
        l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * {mixing.SHARE} - {mixing.CAP} * CAST(coalesce(sum(source_size) OVER o, 0) AS DOUBLE))
                     / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS DOUBLE) AS level FROM f
              WINDOW o AS (ORDER BY full_at, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        lev AS (SELECT level FROM l WHERE level <= full_at ORDER BY full_at, source ASC NULLS LAST LIMIT 1),
        t AS (SELECT source, source_size, n_docs, least(source_size * {float(mixing.CAP)}, coalesce(weight * (SELECT level FROM lev), source_size * {float(mixing.CAP)})) AS target FROM f),
        p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes,
                     CAST(ceil(n_docs / {mixing.BLOCK}.0) AS BIGINT) AS n_blocks FROM t),
        k AS (SELECT d.*, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS rest, md5(concat_ws(':', '{seed}', d.doc_id)) AS key,
                     CAST(('0x' || substr(md5(concat_ws(':', '{seed}', d.doc_id)), 1, 8)) AS BIGINT) % p.n_blocks AS block
              FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
        o AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY md5(concat_ws(':', '{seed}', 'block', source, block)), block, key, doc_id, size
                                        ROWS UNBOUNDED PRECEDING) - size AS start FROM k)
        SELECT doc_id, size, source_size, target, CAST(size * (passes + CASE WHEN start + size / 2.0 <= rest AND start < rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM o"""


def _warc() -> str:
    return """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(encode(coalesce(html, ''))) AS h FROM pages),
        bits AS (SELECT page_id, octet_length(b) AS n, h, array_to_string([
                 lpad(bin(instr('0123456789abcdef', substr(h, CAST(i AS INTEGER), 1)) - 1), 4, '0') FOR i IN range(1, 41)], '') AS z FROM p),
        last AS (SELECT h, max(page_id) AS last FROM p GROUP BY h)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST(1 + 16 * CAST(substr(z, CAST(5 * j + 1 AS INTEGER), 1) AS INTEGER) + 8 * CAST(substr(z, CAST(5 * j + 2 AS INTEGER), 1) AS INTEGER)
                   + 4 * CAST(substr(z, CAST(5 * j + 3 AS INTEGER), 1) AS INTEGER) + 2 * CAST(substr(z, CAST(5 * j + 4 AS INTEGER), 1) AS INTEGER)
                   + CAST(substr(z, CAST(5 * j + 5 AS INTEGER), 1) AS INTEGER) AS INTEGER), 1) FOR j IN range(0, 32)], '') AS payload_digest,
               CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> last THEN last END AS refers_to
        FROM bits JOIN last USING (h)"""


def _embeddings() -> str:
    return """WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
        link AS (SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
        n AS (SELECT u, count(*) AS n FROM link GROUP BY u),
        reach AS (SELECT DISTINCT u AS a, u AS b FROM link UNION SELECT r.a, l.v FROM reach r JOIN link l ON l.u = r.b),
        comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
        SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(c, vec_id) AS component_id, vec_id = coalesce(c, vec_id) AS kept
        FROM embeddings LEFT JOIN n ON n.u = vec_id LEFT JOIN comp ON comp.a = vec_id"""


#: crc32 of a blob by the table of all bytes; ``crc`` holds that table.
CRC_TABLE = """crc AS MATERIALIZED (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""
CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(octet_length({0})),
            lambda i: CAST(('0x' || substr(hex({0}), CAST(2 * i + 1 AS INTEGER), 2)) AS BIGINT))),
            lambda c, b: xor(c >> 8, crc.t[CAST(xor(c, b) & 255 AS INTEGER) + 1])))"""


def _resample() -> str:
    words = f"""unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w"""
    count = lambda name, source: f"{name} AS (SELECT k, sum(n) AS n FROM {source} JOIN bucket USING (w) GROUP BY k)"
    return f"""WITH {CRC_TABLE},
        d AS MATERIALIZED (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, {words} FROM documents) GROUP BY doc_id, w),
        q AS MATERIALIZED (SELECT w, count(*) AS n FROM (SELECT {words} FROM benchmark) GROUP BY w),
        bucket AS MATERIALIZED (SELECT w, {CRC.format("encode(w)")} % 10000 AS k FROM (SELECT w FROM d UNION SELECT w FROM q), crc),
        {count("s", "d")}, {count("t", "q")},
        gain AS (SELECT k, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST((SELECT sum(n) FROM s) + 10000 AS DOUBLE)
                 / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM t) + 10000 AS DOUBLE)))) AS BIGINT) AS g FROM s LEFT JOIN t USING (k)),
        weighed AS (SELECT doc_id, sum(n) AS n, sum(n * g) AS weight FROM d JOIN bucket USING (w) JOIN gain USING (k) GROUP BY doc_id),
        scored AS (SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                   CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('2024:' || doc_id), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
                   FROM documents LEFT JOIN weighed USING (doc_id)),
        ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20)
        SELECT scored.*, CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM ranked) THEN rank END AS rank FROM scored LEFT JOIN ranked USING (doc_id)"""


def _runs() -> str:
    """Pairs of equal words q apart make islands, an island and q more words a
    stretch of period q; of equal stretches the one of smallest period counts."""
    return f"""WITH {CRC_TABLE},
        d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w, {CRC.format("encode(CAST(doc_id AS VARCHAR))")} AS h FROM documents, crc),
        g AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 AS g FROM d),
        a AS (SELECT *, CASE WHEN planted THEN g % n ELSE n END AS a FROM g),
        p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
        places AS (SELECT *, unnest(range(n)) AS i FROM p),
        t AS MATERIALIZED (SELECT doc_id, n, i, w[CAST(1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END AS INTEGER)] AS x FROM places),
        often AS (SELECT *, count(*) OVER (PARTITION BY doc_id, x) AS k FROM t),
        pairs AS (SELECT u.doc_id, u.i, v.i - u.i AS q FROM often u JOIN often v ON u.doc_id = v.doc_id AND u.x = v.x AND v.i > u.i AND 4 * (v.i - u.i) <= u.n
                  WHERE u.k >= 4 AND v.k >= 4),
        isle AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS isle FROM pairs),
        stretch AS (SELECT doc_id, min(i) AS start, count(*) + q AS length, q FROM isle GROUP BY doc_id, q, isle HAVING count(*) + q >= greatest(6, 4 * q)),
        run AS MATERIALIZED (SELECT * FROM stretch QUALIFY row_number() OVER (PARTITION BY doc_id, start, length ORDER BY q) = 1),
        best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, q) = 1),
        listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', q, chr(10)), '' ORDER BY start, q) AS runs FROM run GROUP BY doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM run),
        kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS text FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.start AS BIGINT) AS start, CAST(best.length AS BIGINT) AS length, CAST(best.q AS BIGINT) AS period,
               CAST(1000 * best.length // best.q AS BIGINT) AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
        FROM documents LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_link_trust": _url(), "op2_ngram_jaccard": _ngram(), "op3_mix_sources": _mix(), "op5_warc_round_trip": _warc(),
            "op9_embedding_itq": _embeddings(), "op11_importance_resample": _resample(), "op13_periodic_runs": _runs()}
