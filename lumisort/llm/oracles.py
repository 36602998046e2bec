"""DuckDB SQL for the queries that SQL can express, read literally from their contracts."""

from __future__ import annotations

from collections.abc import Sequence

WORDS = r"[^\x20\x09-\x0D]+"


def repeated_bytes_sql(length: int) -> str:
    """op2: windows as hexadecimal text, two digits a byte."""
    return f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
win AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, {2 * length})) AS h
        FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - {length - 1})) AS i FROM d)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM win) WHERE n > 1),
run AS (SELECT doc_id, i, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -{2 * length}) > {length} AS new FROM again),
span AS (SELECT doc_id, min(i) AS a, max(i) + {length} AS b
         FROM (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM run) GROUP BY doc_id, k),
edge AS (SELECT doc_id, x, list(a ORDER BY a) FILTER (WHERE a IS NOT NULL) AS starts,
                list(b ORDER BY a) FILTER (WHERE a IS NOT NULL) AS stops FROM d LEFT JOIN span USING (doc_id) GROUP BY doc_id, x),
cut AS (SELECT doc_id, x, coalesce(len(starts), 0) AS k, list_prepend(0, coalesce(stops, [])) AS from_, 
               list_append(coalesce(starts, []), length(x) // 2) AS to_ FROM edge)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes,
       CAST(length(x) // 2 - list_sum(list_transform(range(1, k + 2), lambda j: to_[j] - from_[j])) AS BIGINT) AS n_removed,
       CAST(k AS BIGINT) AS n_spans,
       sha256(unhex(array_to_string(list_transform(range(1, k + 2), lambda j: substr(x, 2 * from_[j] + 1, 2 * (to_[j] - from_[j]))), '')))
         AS kept_sha256
FROM cut"""


def repeated_passages_sql(window: int) -> str:
    """op4"""
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + {window - 1}), ' ')) AS h
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {window - 2})) AS i FROM d)),
first AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN first USING (h), range({window}) r(k) WHERE m < doc_id),
word AS (SELECT doc_id, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS p FROM d),
rest AS (SELECT word.doc_id, count(*) AS n, string_agg(v, ' ' ORDER BY word.p) AS t
         FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p WHERE gone.p IS NULL GROUP BY word.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN rest ON d.doc_id = rest.doc_id"""


def _components(nodes: str) -> str:
    """``comp(id, c)`` from ``link(a, b)``, both ways, over ``nodes`` (id)."""
    return f"""reach(id, c) AS (SELECT id, id FROM {nodes} UNION SELECT link.b, reach.c FROM reach JOIN link ON reach.id = link.a),
comp AS (SELECT id, min(c) AS c FROM reach GROUP BY id)"""


def near_vectors_sql(threshold: float) -> str:
    """op5"""
    return f"""
WITH RECURSIVE v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                           AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT p.id AS a, q.id AS b FROM good p JOIN good q ON p.id <> q.id AND len(p.e) = len(q.e)
         WHERE list_cosine_similarity(p.e, q.e) >= {threshold!r}),
{_components("v")}
SELECT v.id AS vec_id, (SELECT count(*) FROM link WHERE a = v.id) AS n_links, c AS component_id, c = v.id AS kept
FROM v JOIN comp ON v.id = comp.id"""


def near_documents_sql(percent: int, shingle: int = 5) -> str:
    """op6"""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{WORDS}') AS w
                     FROM documents),
sh AS (SELECT DISTINCT id, s FROM (
         SELECT id, unnest(CASE WHEN len(w) >= {shingle} THEN list_transform(range(1, len(w) - {shingle - 2}),
                                       lambda i: array_to_string(list_slice(w, i, i + {shingle - 1}), ' '))
                                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d)),
n AS (SELECT id, count(*) AS n FROM sh GROUP BY id),
both AS MATERIALIZED (SELECT p.id AS a, q.id AS b, count(*) AS k FROM sh p JOIN sh q ON p.s = q.s AND p.id <> q.id GROUP BY p.id, q.id),
link AS MATERIALIZED (SELECT a, b FROM both JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * k >= {percent} * (x.n + y.n - k)),
{_components("d")}
SELECT d.id AS doc_id, coalesce(n.n, 0) AS n_shingles, c AS component_id, c = d.id AS kept
FROM d JOIN comp ON d.id = comp.id LEFT JOIN n ON n.id = d.id""".replace("both AS", "common AS").replace("FROM both", "FROM common")


def template_lines_sql(depth: int = 3, similarity: float = 0.7, min_tokens: int = 2, min_merge: int = 6) -> str:
    """op7"""
    bound = "depth + CAST(floor({0} * rest / parts) AS BIGINT)"
    return f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
raw AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM d),
tok AS (SELECT doc_id, p, w, list_transform(w, lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS t
        FROM (SELECT doc_id, p, regexp_extract_all(line, '{WORDS}') AS w FROM raw) WHERE len(w) > 0),
cand AS (SELECT doc_id, p, t, vary, CASE WHEN vary THEN array_to_string(t, ' ') ELSE chr(10) || array_to_string(w, ' ') END AS m
         FROM (SELECT *, len(t) >= {min_tokens} AND 2 * len(list_filter(t, lambda x: x = '<*>')) <= len(t) AS vary FROM tok)),
line AS MATERIALIZED (SELECT m, any_value(t) AS t, lpad(count(*)::VARCHAR, 12, '0') || md5(m) AS often, {depth} AS depth,
                len(any_value(t)) - {depth} AS rest, least(len(any_value(t)) - {depth}, floor(len(any_value(t)) * {1 - similarity!r} + 1e-9) + 1) AS parts
         FROM cand WHERE vary AND len(t) >= {max(min_merge, depth + 1)} GROUP BY m),
held AS (SELECT m, often, [len(t)::VARCHAR] || list_slice(t, 1, {depth}) || ['|', i::VARCHAR]
                || list_slice(t, {bound.format("i")} + 1, {bound.format("(i + 1)")}) AS bucket
         FROM (SELECT *, unnest(range(0, CAST(parts AS BIGINT))) AS i FROM line)),
seed AS (SELECT bucket, max(often) AS often FROM held GROUP BY bucket),
near AS MATERIALIZED (SELECT DISTINCT x.m, s.m AS seed, s.often FROM held JOIN seed ON held.bucket = seed.bucket JOIN line x ON x.m = held.m
         JOIN line s ON s.often = seed.often
         WHERE x.m <> s.m AND list_sum(list_transform(range(1, len(x.t) + 1), lambda i: (x.t[i] = s.t[i])::INT)) / len(x.t) >= {similarity!r}),
of AS (SELECT m, arg_max(seed, often) AS template FROM near WHERE seed NOT IN (SELECT m FROM near) GROUP BY m),
held_by AS (SELECT doc_id, p, coalesce(template, cand.m) AS template FROM cand LEFT JOIN of USING (m)),
first AS (SELECT template, min(doc_id) AS keeper, count(DISTINCT doc_id) AS docs FROM held_by GROUP BY template),
gone AS (SELECT doc_id, p FROM held_by JOIN first USING (template) WHERE docs > 1 AND doc_id <> keeper),
rest AS (SELECT raw.doc_id, count(gone.p) AS k, coalesce(string_agg(line, chr(10) ORDER BY raw.p) FILTER (WHERE gone.p IS NULL), '') AS t
         FROM raw LEFT JOIN gone ON raw.doc_id = gone.doc_id AND raw.p = gone.p GROUP BY raw.doc_id)
SELECT o.doc_id, CAST(coalesce(len(d.l), 0) AS BIGINT) AS n_lines, coalesce(k, 0) AS n_dropped,
       CAST(length(t) AS BIGINT) AS n_chars_kept, sha256(t) AS kept_sha256
FROM documents o LEFT JOIN d ON o.doc_id = d.doc_id LEFT JOIN rest ON o.doc_id = rest.doc_id"""


def url_verdicts_sql(rules: Sequence[tuple[str, str]], damping: float = 0.85, steps: int = 20, seed_share: float = 0.5,
                     threshold: float = 0.5) -> str:
    """op8"""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def host(url: str) -> str:
        return (f"CASE WHEN strpos({url}, '://') > 0 THEN translate(regexp_extract(substr({url}, strpos({url}, '://') + 3), "
                f"'^[^/?#]*'), '{upper}', '{lower}') ELSE '' END")

    whens = []
    for act, rule in sorted(rules, key=lambda r: -len(r[1])):
        h, slash, p = rule.partition("/")
        whens.append((f"WHEN (host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{slash + p}')", rule, act))
    rule_sql = "CASE " + " ".join(f"{w} THEN '{r}'" for w, r, _ in whens) + " END"
    act_sql = "CASE " + " ".join(f"{w} THEN '{a}'" for w, _, a in whens) + " END"
    href = "(?i)\\bhref\\s*=\\s*[\"'']?([^\"''\\s>]+)"
    return f"""
WITH RECURSIVE u AS (SELECT page_id, html, {host("coalesce(url, '')")} AS host,
       CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
     FROM pages),
j AS (SELECT page_id, html, host, path, {rule_sql} AS rule, {act_sql} AS act FROM u),
hosts AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE act = 'allow') AS na, count(*) FILTER (WHERE act = 'block') AS nb
          FROM j WHERE host <> '' GROUP BY host),
href AS (SELECT host AS src, unnest(regexp_extract_all(html, '{href}', 1)) AS l FROM j),
full_ AS (SELECT src, CASE WHEN prefix(l, '//') THEN 'http:' || l ELSE l END AS l FROM href),
pair AS (SELECT src, {host("l")} AS dst FROM full_),
up AS (SELECT h.host AS src, regexp_extract(h.host, '^[^.]+\\.(.+)$', 1) AS dst FROM hosts h),
upper_ AS (SELECT src, dst FROM up WHERE dst IN (SELECT host FROM hosts)),
edge AS (SELECT src, dst, sum(n) AS n FROM (
           SELECT src, dst, 1.0 AS n FROM pair WHERE src <> '' AND dst <> '' AND src <> dst
           UNION ALL SELECT src, dst, 1.0 FROM upper_ UNION ALL SELECT dst, src, 1.0 FROM upper_) GROUP BY src, dst),
both_ AS (SELECT 'trust' AS kind, src, dst, n FROM edge UNION ALL SELECT 'distrust', dst, src, n FROM edge),
share AS MATERIALIZED (SELECT kind, src, dst, n / sum(n) OVER (PARTITION BY kind, src) AS s FROM both_),
seed AS MATERIALIZED (SELECT kind, host, w / sum(w) OVER (PARTITION BY kind) AS s FROM (
          SELECT 'trust' AS kind, host, na::DOUBLE AS w FROM hosts WHERE na >= {seed_share!r} * n AND na > 0
          UNION ALL SELECT 'distrust', host, nb::DOUBLE FROM hosts WHERE nb >= {seed_share!r} * n AND nb > 0)),
walk(i, kind, host, s) AS (
  SELECT 0, kind, host, s FROM seed
  UNION ALL
  SELECT i, kind, host, sum(s) FROM (
    SELECT i + 1 AS i, share.kind AS kind, dst AS host, share.s * walk.s * {damping!r} AS s
    FROM walk JOIN share ON walk.kind = share.kind AND walk.host = share.src WHERE i < {steps}
    UNION ALL SELECT DISTINCT i + 1, seed.kind, seed.host, seed.s * {1 - damping!r} FROM seed, (SELECT DISTINCT i FROM walk WHERE i < {steps})
  ) GROUP BY i, kind, host),
score AS (SELECT host, sum(s) FILTER (WHERE kind = 'trust') AS t, sum(s) FILTER (WHERE kind = 'distrust') AS x FROM walk
          WHERE i = {steps} GROUP BY host)
SELECT page_id, j.host, path, rule, coalesce(act, CASE WHEN coalesce(x, 0) > {threshold!r} * (coalesce(x, 0) + coalesce(t, 0)) THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN score ON j.host = score.host"""


def exact_groups_sql() -> str:
    """op11"""
    return """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256 FROM d"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the ASCII ``text``, bit by bit."""
    step = "xor(s >> 1, (s & 1) * 3988292384)"
    byte = f"list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda s, _: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295::BIGINT)"


def prefix_trie_sql() -> str:
    """op12"""
    return f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(
                    length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) AS p,
                  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {crc32_sql("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
own AS (SELECT c.conv_id, 0 AS k, t.p, role, text FROM c JOIN t ON t.conv_id = c.base WHERE t.p <= c.h
        UNION ALL SELECT c.conv_id, 1, t.p, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE t.p > c.h),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY k, p) AS d, md5(length(role)::VARCHAR || ':' || role || ':' || text) AS x,
             octet_length(encode(text)) AS b FROM own),
s AS (SELECT c.conv_id, coalesce(list(x ORDER BY d) FILTER (WHERE x IS NOT NULL), []) AS xs,
             coalesce(list(b ORDER BY d) FILTER (WHERE x IS NOT NULL), []) AS bs FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
m AS (SELECT conv_id, d, len(xs) AS n, array_to_string(list_slice(xs, 1, d), ',') AS path, array_to_string(list_slice(xs, 1, d - 1), ',') AS up,
             CASE WHEN d = 0 THEN 0 ELSE bs[d] END AS b FROM (SELECT *, unnest(range(0, len(xs) + 1)) AS d FROM s)),
node AS MATERIALIZED (SELECT path, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(b) AS b,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends FROM m GROUP BY path, d),
kids AS (SELECT up, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
full_ AS MATERIALIZED (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids ON kids.up = node.path AND kids.d = node.d),
sub AS (SELECT a.path, a.d, count(*) FILTER (WHERE v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.b) AS saved
        FROM full_ a JOIN full_ v ON v.d >= a.d AND (a.d = 0 OR list_slice(string_split(v.path, ','), 1, a.d) = string_split(a.path, ','))
        GROUP BY a.path, a.d)
SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, sub.n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens,
       f.ends AS ends_sha256
FROM full_ f JOIN sub ON sub.path = f.path AND sub.d = f.d LEFT JOIN full_ p ON f.d > 0 AND p.path = f.up AND p.d = f.d - 1"""


def hard_negatives_sql(positives: int = 5, negatives: int = 3) -> str:
    """op13"""
    return f"""
WITH r AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, a.label AS l, a.q AS aq, r.id, r.label, r.q, CAST(list_dot_product(a.q, r.q) AS BIGINT) AS score
      FROM r a JOIN r ON len(a.q) = len(r.q) WHERE a.id % 50 = 0),
p AS (SELECT anchor_id, aq, l, id AS positive_id, score AS ps FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id, aq, l ORDER BY score DESC, id) AS k FROM s
        WHERE label = l AND NOT (id = anchor_id AND q = aq)) WHERE k <= {positives}),
n AS (SELECT p.anchor_id, positive_id, ps, s.id AS negative_id, score,
             row_number() OVER (PARTITION BY p.anchor_id, p.aq, p.l, positive_id, ps ORDER BY score DESC, s.id) AS k
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND p.aq = s.aq AND p.l = s.l
      WHERE s.label <> p.l AND 50 * ps <= 100 * score AND 100 * score <= 95 * ps)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, ps AS positive_score, score AS negative_score
FROM n WHERE k <= {negatives}"""
