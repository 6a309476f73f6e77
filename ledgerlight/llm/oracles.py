"""DuckDB SQL of the operators that SQL can say whole: searches, scans and the template tree.

Written from the contracts with windows and plain joins; of the operators only
their fixed values (templates, rules, sizes) are read, never a column or plan.
"""

from __future__ import annotations

from . import licenses, secrets, urls

FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _values(rows: list[tuple]) -> str:
    """Rows as a VALUES list."""
    quoted = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return "(VALUES " + ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in rows) + ")"


#: All candidates of every query, so equal to the operator where its lists are all read, as with the one list of few vectors.
NEIGHBOURS = """
WITH v AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda e: e <> 0)) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0),
usual AS (SELECT len(x) AS dim FROM v GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
w AS (SELECT v.* FROM v JOIN usual ON len(x) = dim),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score
  FROM w q JOIN w c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM pairs QUALIFY rank <= 20
"""


def _licenses() -> str:
    phrases = _values([(p, len(p.split()), b) for p, b in licenses.BASE.items()])
    templates = _values([(i, *t) for i, t in enumerate(licenses.TEMPLATES)])
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), {FOLD}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
flat AS MATERIALIZED (
  SELECT rid, i - 1 AS i, w FROM (SELECT rid, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM d)
  WHERE w IN (SELECT unnest(string_split(txt, ' ')) FROM {templates} AS x(t, label, txt, phrase))),
wanted AS (
  SELECT *, unnest(string_split(phrase, ' ')) AS w, generate_subscripts(string_split(phrase, ' '), 1) - 1 AS pos FROM {phrases} AS p(phrase, size, label)),
base AS (
  SELECT rid, i - pos AS start, any_value(label) AS label FROM flat JOIN wanted USING (w) GROUP BY rid, phrase, start HAVING count(*) = any_value(size)),
tpl AS (
  SELECT t, label, string_split(txt, ' ') AS w, string_split(phrase, ' ') AS k FROM {templates} AS x(t, label, txt, phrase)),
idx AS (
  SELECT t, label, p - 1 AS pos, w[p] AS w,
         p BETWEEN first AND first + len(k) - 1 AS key
  FROM (SELECT *, list_filter(range(1, len(w) + 1), lambda j: w[j:j + len(k) - 1] = k)[1] AS first, unnest(range(1, len(w) + 1)) AS p FROM tpl)
  WHERE w[p] NOT IN ({", ".join(f"'{w}'" for w in sorted(licenses.STOP))})),
occ AS (
  SELECT rid, i, w FROM flat WHERE w IN (SELECT w FROM idx)),
weight AS (
  SELECT w, ln(((SELECT count(*) FROM d) + 1) / (count(DISTINCT rid) + 1)) + 1e-3 AS idf, count(rid) AS seen
  FROM (SELECT DISTINCT w FROM idx) LEFT JOIN occ USING (w) GROUP BY w),
rare AS (
  SELECT t, pos, w, least({licenses.AGREEING}, count(*) OVER (PARTITION BY t)) AS need
  FROM idx JOIN weight USING (w) WHERE seen > 0 QUALIFY row_number() OVER (PARTITION BY t ORDER BY idf DESC, w, pos) <= {licenses.INDEXED}),
places AS (
  SELECT rid, t, i - pos AS place FROM occ JOIN rare USING (w) GROUP BY rid, t, place, need HAVING count(*) >= need),
judged AS (
  SELECT p.rid, p.t, p.place, any_value(x.label) AS label, bool_and(o.i IS NOT NULL OR NOT x.key) AS whole,
         coalesce(sum(idf) FILTER (WHERE o.i IS NOT NULL), 0) / sum(idf) AS share
  FROM places p JOIN idx x USING (t) JOIN weight USING (w)
  LEFT JOIN occ o ON o.rid = p.rid AND o.w = x.w AND o.i = p.place + x.pos GROUP BY 1, 2, 3),
more AS (SELECT rid, label, share FROM judged WHERE whole),
named AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT rid, label FROM base UNION ALL SELECT rid, label FROM more WHERE share >= {licenses.LEAST_SHARE} - 1e-9) GROUP BY 1)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(b.labels, '') AS base_labels, coalesce(named.labels, '') AS labels, least(1.0, coalesce(share, 0.0))::DOUBLE AS score
FROM d
LEFT JOIN (SELECT rid, count(*) AS n, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
           FROM base GROUP BY 1) b USING (rid)
LEFT JOIN named USING (rid)
LEFT JOIN (SELECT rid, max(share) AS share FROM more GROUP BY 1) s USING (rid)
"""


def _secrets() -> str:
    # The contract's patterns; RE2 folds beyond ASCII, so both cases are written out.
    either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    assign = ("(" + "|".join(either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
              + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")
    apart = r"(?:^|[^A-Za-z0-9_-])"          # RE2 has no look-behind: the character before is matched, and taken off again
    begin, rest = secrets.FORMATS.split("|(?<![A-Za-z0-9_-])")
    kinds = [(0, "assign", assign, 2, 8), (1, "access", "AKIA[A-Z0-9]+", 0, 16), (2, "hex", "[0-9a-f]+", 0, 32), (3, "format", f"{begin}|{apart}{rest}", 0, 1)]
    found = "\n  UNION ALL ".join(
        f"SELECT rid, owner, repo, {no} AS no, '{name}' AS kind, {group} AS grp, {least} AS least, "
        f"string_split(regexp_replace(text, '{pattern}', chr(1) || '\\0' || chr(1), 'g'), chr(1)) AS parts, '{pattern}' AS pattern FROM d"
        for no, name, pattern, group, least in kinds)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS owner, coalesce(text, '') AS repo, replace(coalesce(text, ''), chr(1), chr(2)) AS text FROM documents),
fenced AS (
  {found}),
seg AS (
  SELECT * EXCLUDE (parts, pattern), unnest(parts) AS s, generate_subscripts(parts, 1) AS k FROM fenced),
placed AS (
  SELECT *, coalesce(sum(length(s)) OVER (PARTITION BY rid, no ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM seg),
hits AS (
  SELECT rid, owner, repo, no, kind, least, a::BIGINT + length(s) - length(m) AS a, a::BIGINT + length(s) AS b,
         CASE WHEN no = 0 THEN regexp_extract(m, '{assign}', 2) ELSE m END AS value
  FROM (SELECT *, CASE WHEN no = 3 AND s[1:1] NOT BETWEEN 'A' AND 'z' AND s[1:1] <> '-' THEN s[2:] ELSE s END AS m FROM placed WHERE k % 2 = 0)),
kept AS (SELECT * FROM hits WHERE length(value) >= least),
copied AS (
  SELECT value FROM (SELECT value, owner, count(DISTINCT repo) AS repositories FROM kept GROUP BY 1, 2)
  GROUP BY value HAVING count(*) >= {secrets.COPIED_OWNERS} OR max(repositories) >= {secrets.COPIED_REPOSITORIES}),
marked AS (
  SELECT *, value IN (SELECT value FROM copied) AS is_copied, len(list_distinct(string_split(value, ''))) >= {secrets.LEAST_SYMBOLS} AS is_random,
         kind || ':' || a || ':' || b AS span FROM kept),
summed AS (
  SELECT rid, count(*) FILTER (WHERE no = 0) AS n_assign, count(*) FILTER (WHERE no = 1) AS n_access, count(*) FILTER (WHERE no = 2) AS n_hex,
         string_agg(span, ',' ORDER BY a, no) FILTER (WHERE no < 3) AS base,
         string_agg(span, ',' ORDER BY a, no) FILTER (WHERE no < 3 OR (is_random AND NOT is_copied)) AS spans,
         count(*) FILTER (WHERE is_random AND NOT is_copied) AS n_live, count(*) FILTER (WHERE is_copied) AS n_copied
  FROM marked GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN summed USING (rid)
"""


def _urls() -> str:
    rules = _values([(v, h, p) for v, h, p in urls.RULES])
    z2 = urls.SIMILAR_Z ** 2
    return rf"""
WITH RECURSIVE cut AS (
  SELECT row_number() OVER () AS rid, page_id, CASE WHEN url LIKE '%://%' THEN url[strpos(url, '://') + 3:] ELSE '' END AS u FROM pages),
parts AS (SELECT rid, page_id, u, regexp_extract(u, '^[^/?#]*') AS h FROM cut),
p AS (
  SELECT rid, page_id, translate(h, {FOLD}) AS host, regexp_extract(u[length(h) + 1:], '^[^?#]*') AS path FROM parts),
fits AS (
  SELECT rid, rhost || rpath AS rule, rverdict
  FROM p JOIN {rules} AS r(rverdict, rhost, rpath) ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC) = 1),
ruled AS (
  SELECT p.*, rule, rverdict,
         array_to_string(list_transform(string_split(regexp_replace(path, '/+$', ''), '/'),
                                        lambda s: CASE WHEN regexp_matches(s, '[0-9]') THEN '*' ELSE s END), '/') AS shape
  FROM p LEFT JOIN fits USING (rid)),
-- One branching a round; rows of nodes that are not grown end there.
grow AS (
  SELECT host, shape, count(*)::DOUBLE AS n, count(rverdict)::DOUBLE AS labelled, (count(*) FILTER (WHERE rverdict = 'block'))::DOUBLE AS bad,
         '' AS template, string_split(shape, '/')[2:] AS rest, 0 AS turn, false AS done
  FROM ruled GROUP BY host, shape
  UNION ALL
  SELECT host, shape, n, labelled, bad,
         CASE WHEN NOT grown THEN template
              ELSE template || CASE WHEN skip > 0 THEN '/' || array_to_string(rest[1:skip], '/') ELSE '' END
                   || CASE WHEN seg IS NULL THEN ''
                           WHEN seg = '*' OR (kids > {urls.WIDE} AND kn < {urls.RARE}::DOUBLE * pn)
                                OR (kl >= {urls.PRIOR} AND pl - kl >= {urls.PRIOR}
                                    AND abs(kb / greatest(kl, 1) - (pb - kb) / greatest(pl - kl, 1))
                                        <= {urls.SIMILAR_Z}::DOUBLE * sqrt(pb / greatest(pl, 1) * (1 - pb / greatest(pl, 1))
                                                                  * (1 / greatest(kl, 1) + 1 / greatest(pl - kl, 1)))) THEN '/*'
                           ELSE '/' || seg END END,
         CASE WHEN grown THEN rest[skip + 2:] ELSE rest END, turn + 1, NOT grown
  FROM (
    SELECT *, CASE WHEN seg IS NOT NULL THEN (dense_rank() OVER (PARTITION BY host, template ORDER BY seg)
                                              + dense_rank() OVER (PARTITION BY host, template ORDER BY seg DESC) - 1 - (count(*) FILTER (WHERE seg IS NULL) OVER (PARTITION BY host, template) > 0)::INT) END AS kids,
           sum(n) OVER child AS kn, sum(labelled) OVER child AS kl, sum(bad) OVER child AS kb
    FROM (
      SELECT *, CASE WHEN grown THEN rest[skip + 1] END AS seg
      FROM (
        SELECT *, lo <> hi AND NOT ((pl = 0 AND turn >= {urls.NAMED}) OR (pl = pn AND (pb = 0 OR pb = pl))) AS grown,
               coalesce(list_position(list_transform(list_zip(lo[1:least(len(lo), len(hi))], hi[1:least(len(lo), len(hi))]), lambda x: x[1] = x[2]), false) - 1,
                        least(len(lo), len(hi))) AS skip
        FROM (
          SELECT host, shape, n, labelled, bad, template, rest, turn, sum(n) OVER node AS pn, sum(labelled) OVER node AS pl, sum(bad) OVER node AS pb,
                 min(rest) OVER node AS lo, max(rest) OVER node AS hi
          FROM grow WHERE NOT done WINDOW node AS (PARTITION BY host, template))))
    WINDOW child AS (PARTITION BY host, template, seg))),
tree AS (
  SELECT host, shape, n, labelled, bad,
         template || CASE WHEN skip > 0 THEN '/' || array_to_string(lo[1:skip], '/') ELSE '' END || CASE WHEN lo <> hi THEN '/**' ELSE '' END AS template
  FROM (
    SELECT *, coalesce(list_position(list_transform(list_zip(lo[1:least(len(lo), len(hi))], hi[1:least(len(lo), len(hi))]), lambda x: x[1] = x[2]), false) - 1,
                       least(len(lo), len(hi))) AS skip
    FROM (SELECT *, min(rest) OVER node AS lo, max(rest) OVER node AS hi FROM grow WHERE done WINDOW node AS (PARTITION BY host, template)))),
hosts AS (
  SELECT host, (sum(bad) + {urls.PRIOR}::DOUBLE * (SELECT coalesce(sum(bad), 0)::DOUBLE / greatest(sum(labelled), 1) FROM tree)) / (sum(labelled) + {urls.PRIOR}::DOUBLE) AS host_purity
  FROM tree GROUP BY host),
judged AS (
  SELECT host, template, sum(n) AS n, sum(labelled) AS l, sum(bad) AS b, (sum(bad) + {urls.PRIOR}::DOUBLE * any_value(host_purity)) / (sum(labelled) + {urls.PRIOR}::DOUBLE) AS purity
  FROM tree JOIN hosts USING (host) GROUP BY 1, 2)
SELECT page_id, r.host, path, rule,
       CASE WHEN rverdict IS NOT NULL THEN rverdict WHEN r.host <> '' AND purity >= {urls.REJECT} AND l > 0 AND
            (b / greatest(l, 1) + {z2}::DOUBLE / (2 * greatest(l, 1)) - {urls.SIMILAR_Z}::DOUBLE * sqrt(b / greatest(l, 1) * (1 - b / greatest(l, 1)) / greatest(l, 1)
             + {z2}::DOUBLE / (4 * greatest(l, 1) * greatest(l, 1)))) / (1 + {z2}::DOUBLE / greatest(l, 1)) > {urls.LOWER} THEN 'block' ELSE 'allow' END AS verdict,
       t.template, purity
FROM ruled r JOIN tree t ON t.host = r.host AND t.shape = r.shape JOIN judged j ON j.host = t.host AND j.template = t.template
"""


#: CRC-32 of doc_id as text (a null one: of no text), a byte at a time.
CRC_TABLE = """(SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)))"""
CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(list_filter(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda ch: ch <> ''),
  lambda ch: ord(ch)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


def _merkle() -> str:
    def leaf(text: str) -> str:
        field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, start: str) -> str:
        """Nodes of all levels, and the runs of the levels below the last."""
        return f"""
{name} AS (
  SELECT tree, 0 AS level, i, digest FROM {start}
  UNION ALL
  SELECT tree, level + 1, i // 8, sha256(string_agg(digest, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS many FROM {name}) WHERE many > 1 GROUP BY tree, level, i // 8),
{name}_runs AS (
  SELECT tree, level, i // 8 AS run, list(digest ORDER BY i) AS ds FROM {name}
  WHERE (tree, level) IN (SELECT tree, level FROM {name} GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1, 2, 3)"""

    def fold(name: str, start: str, runs: str) -> str:
        """Digest and siblings of every leaf, one level at a time up to the root of its tree."""
        return f"""
{name} AS (
  SELECT rid, tree, 0 AS level, i, digest, '' AS proof FROM {start}
  UNION ALL
  SELECT rid, f.tree, f.level + 1, i // 8,
         sha256(array_to_string(ds[1:i % 8], '') || digest || array_to_string(ds[i % 8 + 2:], '')),
         proof || array_to_string(ds[1:i % 8], '') || array_to_string(ds[i % 8 + 2:], '')
  FROM {name} f JOIN {runs} r ON r.tree = f.tree AND r.level = f.level AND r.run = i // 8),
{name}_end AS (SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY level DESC) = 1)"""

    low = f"translate(text, {FOLD})"
    return f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS tree, {leaf("text")} AS leaf,
         CASE WHEN text IS NOT NULL AND crc % 3 = 0 THEN {leaf(low)} END AS bad
  FROM (SELECT *, {CRC} AS crc FROM documents, {CRC_TABLE} AS crc_table(t))),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS i FROM d),
base AS (SELECT tree, i, leaf AS digest FROM leaves),{tree("low", "base")},
subs AS (SELECT tree AS lang_key, digest FROM low QUALIFY row_number() OVER (PARTITION BY tree ORDER BY level DESC) = 1),
tops AS (SELECT '' AS tree, row_number() OVER (ORDER BY lang_key) - 1 AS i, digest, lang_key FROM subs),
top_base AS (SELECT tree, i, digest FROM tops),{tree("top", "top_base")},
whole AS (SELECT digest AS root FROM top ORDER BY level DESC LIMIT 1),
start AS (SELECT rid, tree, i, coalesce(bad, leaf) AS digest FROM leaves),{fold("up", "start", "low_runs")},
middle AS (SELECT rid, '' AS tree, tops.i, u.digest FROM up_end u JOIN tops ON lang_key = u.tree),{fold("over", "middle", "top_runs")}
SELECT doc_id, leaf, s.digest AS subroot, root, sha256(u.proof || o.proof) AS proof_sha256, o.digest AS folded_root, o.digest = root AS verified
FROM leaves l JOIN up_end u ON u.rid = l.rid JOIN over_end o ON o.rid = l.rid JOIN subs s ON s.lang_key = l.tree, whole
"""


NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e) OR abs(256 * e::DOUBLE) >= 16777216)) = 0),
pairs AS (
  SELECT a.rid, a.vec_id AS anchor_id, b.rid AS other, b.vec_id AS other_id, a.label = b.label AS same,
         CASE WHEN len(a.x) = 0 THEN 0 ELSE list_inner_product(a.x, b.x) END::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.rid <> b.rid AND len(a.x) = len(b.x)),
positives AS (
  SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
       row_number() OVER (PARTITION BY p.rid, p.other ORDER BY n.score DESC, n.other_id)::INT AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.rid = p.rid AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""


WARC = """
WITH p AS (
  SELECT row_number() OVER () AS rid, page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
ranked AS (
  SELECT *, row_number() OVER same AS place, first_value(page_id) OVER same AS first_id
  FROM p WINDOW same AS (PARTITION BY payload_digest, payload_bytes ORDER BY page_id DESC NULLS LAST, rid))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN place > 1 AND payload_bytes >= 1000 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN place > 1 AND payload_bytes >= 1000 THEN first_id END AS refers_to
FROM ranked
"""


ORACLES: dict[str, str] = {"op3_neighbours": NEIGHBOURS, "op4_licenses": _licenses(), "op6_secrets": _secrets(), "op7_urls": _urls(),
                           "op11_manifest": _merkle(), "op12_negatives": NEGATIVES, "op13_warc": WARC}
