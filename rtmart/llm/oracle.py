"""DuckDB SQL for the operators that SQL can express."""

from rtmart.llm.license_rules import CONFIDENCE, license_rules

OP2_LINE_DEDUP = r"""
WITH docs AS (
  SELECT doc_id, source, text, md5(concat_ws('|', doc_id, source, md5(text))) AS k FROM documents
), l AS (
  SELECT doc_id, k, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM docs WHERE text IS NOT NULL
), n AS (
  SELECT *, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), b AS (
  SELECT norm, min(doc_id) AS first_id FROM n GROUP BY norm HAVING count(DISTINCT site) >= 10
), f AS (
  SELECT n.norm, n.doc_id, min(n.pos) AS first_pos
  FROM n JOIN b ON n.norm = b.norm AND n.doc_id = b.first_id GROUP BY 1, 2
), gone AS (
  SELECT n.k, n.pos FROM n JOIN f ON n.norm = f.norm
  WHERE n.doc_id <> f.doc_id OR n.pos <> f.first_pos
), kept AS (
  SELECT l.k, count(g.pos) AS n_removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL), '') AS t
  FROM l LEFT JOIN gone g ON l.k = g.k AND l.pos = g.pos GROUP BY l.k
)
SELECT d.doc_id, coalesce(n_removed, 0) AS n_removed, length(t) AS n_chars, md5(t) AS text_md5
FROM docs d LEFT JOIN kept USING (k)
"""

OP3_QUALITY_RULES = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, list_slice(w, i, i + 4) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM docs)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win)
  WHERE n > 1
), rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM twice, range(0, 5) t(k) GROUP BY doc_id
), l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM docs
), ln AS (
  SELECT doc_id, source, line, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS line_words
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln GROUP BY doc_id
), often AS (
  SELECT source, norm, min(doc_id) AS first_id FROM ln GROUP BY 1, 2
  HAVING count(DISTINCT doc_id) > 50
), rem AS (
  SELECT ln.doc_id, sum(line_words) AS removed_words
  FROM ln JOIN often o ON ln.norm = o.norm AND ln.source IS NOT DISTINCT FROM o.source
  WHERE ln.doc_id <> o.first_id GROUP BY ln.doc_id
), s AS (
  SELECT doc_id, len(w) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(removed_words, 0)::BIGINT AS removed_words
  FROM docs LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN rem USING (doc_id)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND 100 * (n_words - removed_words) >= 10 * n_words AS kept
FROM s
"""

#: Exact: the operator's recall is measured against it.
OP4_EMBEDDING_NEAR_DEDUP = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), ok AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM ok a JOIN ok b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) / (a.norm * b.norm) >= 0.95
), reach AS (
  SELECT vec_id AS u, vec_id AS w FROM v
  UNION SELECT r.u, l.w FROM reach r JOIN link l ON r.w = l.u
)
SELECT v.vec_id, (SELECT count(*) FROM link WHERE u = v.vec_id) AS n_links,
       min(r.w) AS component_id, v.vec_id = min(r.w) AS kept
FROM v JOIN reach r ON r.u = v.vec_id GROUP BY v.vec_id
"""


def _url_filters(rounds: int = 90, damping: float = 0.85) -> str:
    """The propagation unrolled: one relation per round."""
    ranks = "r0 AS (SELECT kind, host, seed AS rank FROM seeds)"
    for i in range(rounds):
        ranks += f"""
, g{i} AS (
  SELECT w.kind, w.dst AS host, sum(r.rank * w.share) AS got
  FROM ways w JOIN r{i} r ON r.kind = w.kind AND r.host = w.src GROUP BY 1, 2
), l{i} AS (
  SELECT k.kind, 1 - coalesce(sum(got), 0) AS lost
  FROM (SELECT DISTINCT kind FROM seeds) k LEFT JOIN g{i} g ON g.kind = k.kind GROUP BY 1
), r{i + 1} AS (
  SELECT kind, host, (1 - {damping}) * coalesce(seed, 0)
         + {damping} * (coalesce(got, 0) + lost * coalesce(seed, 0)) AS rank
  FROM seeds FULL JOIN g{i} USING (kind, host) JOIN l{i} USING (kind)
)"""
    return r"""
WITH rules(verdict, rule) AS (
  VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'),
         ('allow', 'com/fr/'), ('block', 'com/de/')
), rl AS (
  SELECT verdict, rule, split_part(rule, '/', 1) AS rh, substr(rule, strpos(rule, '/')) AS rp FROM rules
), u AS (
  SELECT page_id, html, CASE WHEN strpos(url, '://') > 0
         THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, html, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), j AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS rule_verdict
  FROM p JOIN rl ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY 1
), judged AS (
  SELECT p.page_id, host, path, rule, rule_verdict FROM p LEFT JOIN j USING (page_id)
), links AS (
  SELECT src, dst, count(*) AS n FROM (
    SELECT DISTINCT page_id, host AS src, lower(unnest(regexp_extract_all(html,
      '(?i)href\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s>]+)', 1))) AS dst FROM p)
  WHERE src <> dst AND src <> '' GROUP BY 1, 2
), ways AS (
  SELECT 'trust' AS kind, src, dst, n / sum(n) OVER (PARTITION BY src) AS share FROM links
  UNION ALL SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM links
), shares AS (
  SELECT host, avg((rule_verdict IS NOT DISTINCT FROM 'allow')::INT) AS t,
         avg((rule_verdict IS NOT DISTINCT FROM 'block')::INT) AS d
  FROM judged WHERE host <> '' GROUP BY host
), weights AS (
  SELECT 'trust' AS kind, host, t AS w FROM shares WHERE t >= 0.5
  UNION ALL SELECT 'distrust', host, d FROM shares WHERE d >= 0.5
), seeds AS (
  SELECT kind, host, w / sum(w) OVER (PARTITION BY kind) AS seed FROM weights
), """ + ranks + f"""
, hosts AS (
  SELECT host, sum(rank) FILTER (kind = 'trust') AS t, sum(rank) FILTER (kind = 'distrust') AS d
  FROM r{rounds} GROUP BY host
)
SELECT page_id, host, path, rule, coalesce(rule_verdict,
       CASE WHEN d > 0 AND d >= 0.5 * (coalesce(t, 0) + d) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN hosts USING (host)
"""


def _license_scans() -> str:
    """Words stand between spaces of their own, so neighbouring matches share none."""
    def spaced(pattern: str) -> str:
        parts = [part.replace(" ", "  ") for part in pattern.split(" ?")]
        return " " + "(?:  )?".join(parts) + " "

    rules = ",\n".join(
        f"({i}, {tier}, '{label}', '{keyword}', '{spaced(pattern)}', {CONFIDENCE[tier]})"
        for i, (tier, label, keyword, pattern) in enumerate(license_rules()))
    return r"""
WITH rules(rule, tier, label, keyword, pattern, sure) AS (VALUES
""" + rules + r"""
), n AS (
  SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')) AS t FROM documents
), w AS (
  SELECT doc_id, t, CASE WHEN t = '' THEN [] ELSE string_split(t, ' ') END AS words FROM n
), positions AS (
  SELECT doc_id, words, unnest(range(len(words))) AS i FROM w
), base AS (
  SELECT doc_id, i, unnest(list_filter([
    CASE WHEN words[i + 1] = 'cc' AND words[i + 2] = 'by' THEN 'cc-by' END,
    CASE WHEN words[i + 1] = 'general' AND words[i + 2] = 'public' AND words[i + 3] = 'license'
         THEN 'gpl' END,
    CASE WHEN words[i + 1] = 'all' AND words[i + 2] = 'rights' AND words[i + 3] = 'reserved'
         THEN 'reserved' END], lambda x: x IS NOT NULL)) AS label FROM positions
), places AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id
), tried AS (
  SELECT doc_id, r.*, regexp_extract_all(s, pattern) AS m, string_split_regex(s, pattern) AS g
  FROM (SELECT doc_id, t, ' ' || replace(t, ' ', '  ') || ' ' AS s FROM n WHERE t <> '') d
  JOIN rules r ON contains(' ' || t, ' ' || keyword)
), cut AS (
  SELECT doc_id, rule, tier, label, sure, k, (length(m[k]) - length(replace(m[k], ' ', ''))) // 2 AS mw,
         (length(g[k]) - length(replace(g[k], ' ', ''))) // 2 AS gw
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS k FROM tried)
), spans AS (
  SELECT doc_id, tier, label, sure, mw, sum(gw + mw) OVER (PARTITION BY doc_id, rule ORDER BY k) - mw AS a
  FROM cut
), kept AS (
  SELECT DISTINCT x.doc_id, x.label, x.sure FROM spans x WHERE NOT EXISTS (
    SELECT 1 FROM spans y WHERE y.doc_id = x.doc_id AND y.a <= x.a AND y.a + y.mw >= x.a + x.mw
    AND (y.tier < x.tier OR (y.tier = x.tier AND y.mw > x.mw)))
), labelled AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(sure) AS sure
  FROM (SELECT * FROM kept UNION ALL SELECT doc_id, label, 0.5 FROM base) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(sure, 0)::DOUBLE AS score
FROM w LEFT JOIN places USING (doc_id) LEFT JOIN labelled USING (doc_id)
"""


ORACLES = {
    "op1_url_filters": _url_filters(),
    "op2_line_dedup": OP2_LINE_DEDUP,
    "op3_quality_rules": OP3_QUALITY_RULES,
    "op4_embedding_near_dedup": OP4_EMBEDDING_NEAR_DEDUP,
    "op9_license_scans": _license_scans(),
}


# Every document's five failures, then every step of every order by brute force.
ORACLES["op12_filter_interaction_audit"] = r"""
WITH l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                  max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
           FROM labels GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
f AS (
  SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         (CASE WHEN len(words) < 100 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text)
                  THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
      FROM letter a, letter b, letter c, letter d, letter e
      WHERE a.x <> b.x AND a.x <> c.x AND a.x <> d.x AND a.x <> e.x AND b.x <> c.x AND b.x <> d.x
        AND b.x <> e.x AND c.x <> d.x AND c.x <> e.x AND d.x <> e.x),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
t AS (
  SELECT c.part, s.filter_order, s.step, s.own,
         -- the letters that both strings have: none when nothing was failed before
         CASE WHEN s.before = '' OR NOT regexp_matches(c.fails, '[' || s.before || ']') THEN 1 ELSE 0 END AS alive,
         CASE WHEN contains(c.fails, s.own) THEN 1 ELSE 0 END AS hit,
         CASE WHEN c.fails = s.own THEN 1 ELSE 0 END AS alone, c.n, c.good, c.toxic
  FROM c, s),
r AS (
  SELECT part, filter_order, step, own,
         CAST(sum(n * alive * (1 - hit)) AS BIGINT) AS kept, CAST(sum(n * alive * hit) AS BIGINT) AS removed,
         CAST(sum(n * (1 - alive) * hit) AS BIGINT) AS redundant, CAST(sum(n * alone) AS BIGINT) AS unique_fails,
         CAST(sum(good * alive * hit) AS BIGINT) AS good_lost,
         CAST(sum(toxic * alive * hit) AS BIGINT) AS toxic_lost
  FROM t GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r"""


def _codes_sql() -> str:
    """Two rounds of assignment and averaging over (vector, part, position) rows."""
    def assigned(books: str) -> str:
        return f"""
  SELECT vec_id, part, entry, dist FROM (
    SELECT v.vec_id, v.part, b.entry, CAST(sum((v.x - b.x) * (v.x - b.x)) AS BIGINT) AS dist
    FROM v JOIN {books} b ON b.part = v.part AND b.pos = v.pos
    GROUP BY v.vec_id, v.part, b.entry)
  QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY dist, entry) = 1"""

    def moved(books: str, a: str) -> str:
        return f"""
  SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x
  FROM {books} b LEFT JOIN (
    SELECT v.part, a.entry, v.pos,
           CAST((sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
    FROM v JOIN {a} a ON a.vec_id = v.vec_id AND a.part = v.part GROUP BY v.part, a.entry, v.pos) m
  ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos"""

    return f"""
WITH e AS (
  SELECT vec_id, label, embedding, len(embedding) // 16 AS width FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (
  SELECT vec_id, (i - 1) // width AS part, (i - 1) % width AS pos,
         CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT vec_id, embedding, width, unnest(range(1, len(embedding) + 1)) AS i FROM e)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM e
          QUALIFY entry < 64),
b0 AS MATERIALIZED (SELECT v.part, first.entry, v.pos, v.x FROM v JOIN first ON first.vec_id = v.vec_id),
a0 AS MATERIALIZED ({assigned("b0")}),
b1 AS MATERIALIZED ({moved("b0", "a0")}),
a1 AS MATERIALIZED ({assigned("b1")}),
b2 AS MATERIALIZED ({moved("b1", "a1")}),
a2 AS MATERIALIZED ({assigned("b2")}),
c AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
             CAST(sum(dist) AS BIGINT) AS error FROM a2 GROUP BY vec_id)
SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY e.label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b2) AS codebooks_sha256
FROM c JOIN e ON e.vec_id = c.vec_id"""


ORACLES["op13_vector_code_compression"] = _codes_sql()
