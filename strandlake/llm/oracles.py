"""DuckDB SQL that gives the rows of the queries SQL can express."""

OP5 = r"""
WITH k AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM k GROUP BY text_sha256)
SELECT k.doc_id, g.keep_id, g.group_size, k.doc_id = g.keep_id AS kept, k.text_sha256
FROM k JOIN g USING (text_sha256)
"""

SQL = {"op5_exact_dedup": OP5}

_OP1_ROUND = r"""
{p}e AS (
  SELECT d.doc_id, d.source, d.h, d.size, b."left", sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto
  FROM sized d JOIN {b} b ON d.source IS NOT DISTINCT FROM b.source
  WHERE d.size > 0 AND b."left" > 0 AND d.h > b.floor_h AND (b.floor_h = -1 OR d.size <= b."left")),
{p}x AS (SELECT source, min(h) FILTER (upto > "left") AS edge, max(h) AS top FROM {p}e GROUP BY source),
{p}t AS (
  SELECT e.doc_id, e.source, e.size FROM {p}e e JOIN {p}x x ON e.source IS NOT DISTINCT FROM x.source
  WHERE x.edge IS NULL OR e.h < x.edge),
{p}l AS (
  SELECT b.source, b."left" - coalesce((SELECT sum(t.size) FROM {p}t t WHERE t.source IS NOT DISTINCT FROM b.source), 0) AS "left",
         coalesce(x.edge, x.top, b.floor_h) AS floor_h
  FROM {b} b LEFT JOIN {p}x x ON b.source IS NOT DISTINCT FROM x.source)"""

OP1 = (
    r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ' ' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM sized GROUP BY source),
lev AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / weight AS ratio FROM src),
lev2 AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lam
  FROM lev),
tgt AS (
  SELECT source, source_size,
         least(cap, weight * (SELECT min_by(lam, ratio) FROM lev2 WHERE lam <= ratio)) AS target FROM lev2),
b0 AS (
  SELECT source, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS whole FROM tgt),
ba AS (SELECT source, floor(target - whole * source_size)::BIGINT AS "left", -1 AS floor_h FROM b0),"""
    + ",".join(_OP1_ROUND.format(p=p, b=b) for p, b in (("p", "ba"), ("q", "pl"), ("r", "ql")))
    + r""",
last AS (
  SELECT e.doc_id FROM pe e JOIN px x ON e.source IS NOT DISTINCT FROM x.source JOIN rl l ON l.source IS NOT DISTINCT FROM e.source
  WHERE e.h = x.edge AND e.size < 2 * l."left"),
extra AS (SELECT doc_id FROM pt UNION ALL SELECT doc_id FROM qt UNION ALL SELECT doc_id FROM rt UNION ALL SELECT doc_id FROM last)
SELECT d.doc_id, d.size, b0.source_size, b0.target, (d.size * (b0.whole + (d.doc_id IN (SELECT doc_id FROM extra))::BIGINT))::BIGINT AS taken
FROM sized d JOIN b0 ON d.source IS NOT DISTINCT FROM b0.source
"""
)

SQL |= {"op1_source_mix": OP1}

OP10 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(text, '\', '\\'), '<', '\<') AS t, replace(replace(replace(role, '\', '\\'), '<', '\<'), chr(10), '\' || chr(10)) AS r FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(t) + length(r) + 15)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

SQL |= {"op10_chat_format": OP10}

OP7 = r"""
WITH v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e,
         embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok FROM embeddings),
p AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.ok AND b.ok AND list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (WITH RECURSIVE w(x, y) AS (SELECT x, y FROM p UNION SELECT w.x, p.y FROM w JOIN p ON w.y = p.x) SELECT x, min(y) AS y FROM w GROUP BY x)
SELECT v.vec_id, (SELECT count(*) FROM p WHERE p.x = v.vec_id) AS n_links, least(v.vec_id, coalesce(r.y, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(r.y, v.vec_id)) AS kept
FROM v LEFT JOIN r ON r.x = v.vec_id
"""

SQL |= {"op7_embedding_dedup": OP7}

OP8 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS k FROM s GROUP BY doc_id),
r AS (SELECT k, min(doc_id) AS node, any_value(n) AS n FROM n GROUP BY k),
t AS (SELECT r.node, r.n, s.s FROM r JOIN s ON s.doc_id = r.node),
p AS (SELECT a.node AS x, b.node AS y FROM t a JOIN t b ON a.s = b.s AND a.node < b.node AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
l AS (SELECT x, y FROM p UNION SELECT y, x FROM p),
c(x, y) AS (SELECT x, y FROM l UNION SELECT c.x, l.y FROM c JOIN l ON c.y = l.x),
m AS (SELECT x, least(x, min(y)) AS name FROM c GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.name, r.node, w.doc_id) AS component_id, w.doc_id = coalesce(m.name, r.node, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN r ON r.k = n.k LEFT JOIN m ON m.x = r.node
"""

SQL |= {"op8_minhash_dedup": OP8}

OP2 = r"""
WITH hexed AS (SELECT doc_id, lang, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS h FROM documents),
bytes AS (SELECT doc_id, lang, generate_subscripts(h, 1) AS i, ('0x' || unnest(h))::BIGINT AS v FROM hexed),
low AS (SELECT doc_id, lang, i, CASE WHEN v BETWEEN 65 AND 90 THEN v + 32 ELSE v END AS v FROM bytes),
three AS (SELECT doc_id, lang, v AS a, lead(v) OVER w AS b, lead(v, 2) OVER w AS c FROM low WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
grams AS (SELECT doc_id, lang, ((a * 2654435761 + b * 2246822519 + c * 3266489917) & 4294967295) >> 19 AS bin FROM three WHERE c IS NOT NULL AND (b BETWEEN 97 AND 122 OR b >= 128)),
counts AS (SELECT lang, bin, count(*) AS n FROM grams WHERE lang IS NOT NULL GROUP BY lang, bin),
langs AS (SELECT l.lang, coalesce(sum(n), 0) + 4096.0::DOUBLE AS total FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL) l LEFT JOIN counts USING (lang) GROUP BY l.lang),
each AS (SELECT doc_id, bin, count(*) AS k FROM grams GROUP BY doc_id, bin),
said AS (SELECT e.doc_id, l.lang, sum(k) AS grams, sum(k * ln((coalesce(c.n, 0) + 0.5::DOUBLE) / l.total)::FLOAT::DOUBLE) AS s FROM each e CROSS JOIN langs l LEFT JOIN counts c ON c.lang = l.lang AND c.bin = e.bin GROUP BY e.doc_id, l.lang),
likely AS (SELECT d.doc_id, l.lang, coalesce(grams, 0) AS grams, coalesce(s, 0) * (least(coalesce(grams, 0), 60) / greatest(coalesce(grams, 0), 1)::DOUBLE) AS s FROM documents d CROSS JOIN langs l LEFT JOIN said t ON t.doc_id = d.doc_id AND t.lang = l.lang),
best AS (SELECT doc_id, arg_min(lang, (-s, lang)) AS look, max(s) AS top, any_value(grams) AS grams FROM likely GROUP BY doc_id),
page AS (SELECT page_id, try_cast(regexp_extract(url, '^[a-zA-Z]+://[^/?#]+/(?:[^?#]*/)?(\d{1,18})(?:\.[a-z]+)?/?(?:[?#]|$)', 1) AS BIGINT) AS doc_id,
  nullif(lower(regexp_extract(html, '<html[^>]*\blang=["'']?([A-Za-z-]+)', 1)), '') AS declared, nullif(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '') AS host FROM pages),
address AS (SELECT doc_id, arg_min((declared, host), page_id) AS p FROM page WHERE doc_id IS NOT NULL GROUP BY doc_id),
facts AS (SELECT d.doc_id, b.look, b.top, b.grams, a.p[1] AS declared, coalesce(a.p[2], lower(d.source)) AS host, nullif(lower(regexp_extract(a.p[2], '\.([A-Za-z]+)$', 1)), '') AS suffix
  FROM documents d JOIN best b USING (doc_id) LEFT JOIN address a USING (doc_id)),
k AS (SELECT count(*)::DOUBLE AS k FROM langs),
looks AS (SELECT * FROM facts WHERE grams > 0),
whole AS (SELECT l.lang, count(f.doc_id)::DOUBLE AS n FROM langs l LEFT JOIN looks f ON f.look = l.lang GROUP BY l.lang),
corpus AS (SELECT lang, (n + 20 / k) / (sum(n) OVER () + 20) AS p FROM whole, k),
suffixes AS (SELECT s.suffix, l.lang, (count(f.doc_id) FILTER (f.look = l.lang) + 20 * c.p) / (count(f.doc_id) + 20) AS p
  FROM (SELECT DISTINCT suffix FROM looks WHERE suffix IS NOT NULL) s CROSS JOIN langs l JOIN corpus c USING (lang) JOIN looks f ON f.suffix = s.suffix GROUP BY s.suffix, l.lang, c.p),
hosts AS (SELECT h.host, h.suffix, l.lang, (count(f.doc_id) FILTER (f.look = l.lang) + 20 * coalesce(s.p, c.p)) / (count(f.doc_id) + 20) AS p
  FROM (SELECT DISTINCT host, suffix FROM looks WHERE host IS NOT NULL) h CROSS JOIN langs l JOIN corpus c USING (lang) LEFT JOIN suffixes s ON s.suffix = h.suffix AND s.lang = l.lang
  JOIN looks f ON f.host = h.host AND f.suffix IS NOT DISTINCT FROM h.suffix GROUP BY h.host, h.suffix, l.lang, s.p, c.p),
says AS (SELECT d.declared, w.lang, ln((count(f.doc_id) FILTER (f.look = w.lang) + 1 / k.k) / (w.n + 1)) AS p
  FROM (SELECT DISTINCT declared FROM looks WHERE declared IS NOT NULL) d CROSS JOIN whole w CROSS JOIN k JOIN looks f ON f.declared = d.declared GROUP BY d.declared, w.lang, w.n, k.k),
fused AS (SELECT f.doc_id, l.lang, (l.s - f.top) + ln(coalesce(h.p, s.p, c.p)) + coalesce(y.p, 0) AS x
  FROM facts f JOIN likely l USING (doc_id) JOIN corpus c ON c.lang = l.lang LEFT JOIN hosts h ON h.host = f.host AND h.suffix IS NOT DISTINCT FROM f.suffix AND h.lang = l.lang
  LEFT JOIN suffixes s ON s.suffix = f.suffix AND s.lang = l.lang LEFT JOIN says y ON y.declared = f.declared AND y.lang = l.lang),
told AS (SELECT doc_id, arg_min(lang, (-x, lang)) AS lang, 1 / sum(exp(x - m)) AS posterior FROM (SELECT *, max(x) OVER (PARTITION BY doc_id) AS m FROM fused) GROUP BY doc_id)
SELECT f.doc_id, t.lang, round(t.posterior, 6) AS posterior, CASE WHEN f.grams > 0 THEN f.look END AS text_lang, f.declared, f.host, f.grams > 0 AND t.posterior >= 0.5 AS kept FROM facts f JOIN told t USING (doc_id)
"""

SQL |= {"op2_language_id": OP2}

OP11 = r"""
WITH w AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, md5(coalesce(text, '')) AS digest, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w)),
twice AS (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) > 1),
places AS (SELECT g.doc_id, g.i FROM g JOIN twice USING (doc_id, g)),
rep AS (SELECT doc_id, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM places) GROUP BY doc_id),
base AS (
  SELECT w.doc_id, lang AS stratum, digest, len(w)::BIGINT AS n_words, len(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         len(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base),
vals AS (
  SELECT doc_id, unnest(['symbols', 'long', 'short', 'dup', 'rep']) AS measure, unnest([
    least(1000 * n_symbols // n_words, 10000), least(100 * word_chars // n_words, 10000), 10000 - least(100 * word_chars // n_words, 10000),
    1000 * n_dup_lines // greatest(n_lines, 1), 1000 * n_repeat_words // n_words]) AS v
  FROM b WHERE NOT base_failed),
good AS (
  SELECT stratum, digest, min(b.doc_id) AS doc_id FROM b JOIN (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1) l ON l.doc_id = b.doc_id
  WHERE NOT base_failed GROUP BY stratum, digest),
prop AS (SELECT g.stratum, v.measure, v.v, count(*) AS n FROM good g JOIN vals v USING (doc_id) WHERE substr(g.digest, 1, 1) < '8' GROUP BY g.stratum, v.measure, v.v),
ranked AS (
  SELECT stratum, measure, v, coalesce(sum(n) OVER (PARTITION BY stratum, measure ORDER BY v DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above,
         sum(n) OVER (PARTITION BY stratum, measure) AS total FROM prop),
rungs AS (SELECT unnest([0, 1, 2, 3]) AS level, unnest([0, 1, 2, 5]) AS rung),
cuts AS (SELECT stratum, measure, level, min(v) AS cut FROM ranked CROSS JOIN rungs WHERE 1000 * above <= rung * total GROUP BY stratum, measure, level),
held AS (
  SELECT g.stratum, g.digest, min(c.level) FILTER (v.v > c.cut) AS lost FROM good g JOIN vals v USING (doc_id) JOIN cuts c ON c.stratum IS NOT DISTINCT FROM g.stratum AND c.measure = v.measure
  WHERE substr(g.digest, 1, 1) >= '8' GROUP BY g.stratum, g.digest),
hits AS (SELECT stratum, level, count(*) AS n, count(*) FILTER (lost <= level) AS k FROM held CROSS JOIN rungs GROUP BY stratum, level),
tails AS (
  SELECT stratum, level, list_sum(list_transform(generate_series(0, k), lambda i: exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln(0.05) + (n - i) * ln(0.95)))) AS tail,
         (SELECT count(*) FROM (SELECT DISTINCT stratum FROM hits)) AS strata FROM hits),
best AS (
  SELECT stratum, max(level) AS level FROM (SELECT *, max(CASE WHEN tail <= 0.1 / strata THEN 0 ELSE 1 END) OVER (PARTITION BY stratum ORDER BY level) AS failed FROM tails)
  WHERE failed = 0 GROUP BY stratum),
limits AS (SELECT c.stratum, c.measure, c.cut FROM cuts c JOIN best t ON t.stratum IS NOT DISTINCT FROM c.stratum AND t.level = c.level),
bad AS (SELECT DISTINCT b.doc_id FROM b JOIN vals v USING (doc_id) JOIN limits l ON l.stratum IS NOT DISTINCT FROM b.stratum AND l.measure = v.measure WHERE v.v > l.cut)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM b
"""

SQL |= {"op11_quality_rules": OP11}

# crc32 of a decimal number: the table of 256 words from its polynomial, then one step a digit
_CRC = """
tab AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, generate_series(1, 8)), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i)))"""
_CRC_OF = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all({x}::VARCHAR, '.'), lambda ch: ascii(ch)::BIGINT)), lambda a, ch: xor(a >> 8, tab[(xor(a, ch) & 255) + 1])), 4294967295)"
_FIELD = "coalesce(octet_length(encode({x}::VARCHAR))::VARCHAR || ':' || {x}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(x=x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _merkle(levels: int) -> str:
    """The manifest for sources, and a number of sources, of at most 16**levels nodes."""
    steps = ["""n0 AS (SELECT dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, leaf AS node, doc_id FROM d)"""]
    for tree, first in (("n", "n0"), ("s", "s0")):
        if tree == "s":
            steps.append(f"s0 AS (SELECT 0 AS grp, grp AS i, node FROM n{levels})")
        for k in range(levels):
            held = f"(SELECT *, count(*) OVER (PARTITION BY grp) AS size FROM {tree}{k})"
            steps.append(
                f"{tree}{k + 1} AS (SELECT grp, i // 16 AS i, CASE WHEN any_value(size) > 1 THEN sha256(string_agg(node, '' ORDER BY i)) ELSE any_value(node) END AS node FROM {held} GROUP BY grp, i // 16)"
            )
            steps.append(
                f"{tree}p{k} AS (SELECT a.grp, a.i, any_value(a.size) > 1 AS real, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS b, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS a"
                f" FROM {held} a JOIN {tree}{k} b ON a.grp = b.grp AND a.i // 16 = b.i // 16 GROUP BY a.grp, a.i)"
            )
    joins, proof, folds = "", [], []
    for tree in ("n", "s"):
        for k in range(levels):
            name = f"{tree}p{k}"
            group, place = ("n0.grp", f"n0.i // {16**k}") if tree == "n" else ("0", f"n0.grp // {16**k}")
            joins += f" JOIN {name} ON {name}.grp = {group} AND {name}.i = {place}"
            proof.append(f"CASE WHEN {name}.real THEN {name}.b || {name}.a ELSE '' END")
            folds.append(name)
    columns = ", ".join(f"{n}.real AS r{j}, {n}.b AS b{j}, {n}.a AS a{j}" for j, n in enumerate(folds))
    chain = ["f0 AS (SELECT *, coalesce(tampered, leaf) AS x FROM j)"]
    for j in range(len(folds)):
        chain.append(f"f{j + 1} AS (SELECT * EXCLUDE (x), CASE WHEN r{j} THEN sha256(b{j} || x || a{j}) ELSE x END AS x FROM f{j})")
    return (
        f"WITH {_CRC},\nd AS (SELECT doc_id, source, {_leaf('text')} AS leaf, CASE WHEN {_CRC_OF.format(x='doc_id')} % 5 = 0 THEN {_leaf(_LOWER)} END AS tampered FROM documents CROSS JOIN tab),\n"
        + ",\n".join(steps)
        + f",\nj AS (SELECT d.doc_id, d.leaf, d.tampered, top.node AS subroot, (SELECT node FROM s{levels}) AS root, sha256({' || '.join(proof)}) AS proof_sha256, {columns}"
        + f" FROM n0 JOIN d ON d.doc_id = n0.doc_id JOIN n{levels} top ON top.grp = n0.grp{joins}),\n"
        + ",\n".join(chain)
        + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, x AS folded_root, x = root AS verified FROM f{len(folds)}"
    )


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL |= {"op13_merkle_manifest": _merkle(4)}
