"""SQL (DuckDB) for the operations that SQL can express, over the same tables."""

from __future__ import annotations

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# Every 50-byte string as hex digits, the smallest document that has it, and islands of covered bytes.
RUN_INDEX_DEDUP = """
WITH raw AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), strings AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 49, 0))) AS p FROM raw)
), owners AS (
  SELECT s, min(doc_id) AS owner FROM strings GROUP BY s
), repeated AS (
  SELECT doc_id, p FROM strings JOIN owners USING (s) WHERE owner < doc_id
), opened AS (
  SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 50, true) AS opens FROM repeated
), numbered AS (
  SELECT doc_id, p, sum(opens::int) OVER (PARTITION BY doc_id ORDER BY p) AS island FROM opened
), islands AS (
  SELECT doc_id, island, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY ALL
), pieces AS (
  SELECT doc_id, island, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM islands
  UNION ALL
  SELECT r.doc_id, 1000000000, coalesce(max(i.b), 0), length(any_value(r.h)) // 2
  FROM raw r LEFT JOIN islands i ON i.doc_id = r.doc_id GROUP BY r.doc_id
), kept AS (
  SELECT p.doc_id, string_agg(substr(h, (2 * a + 1)::bigint, (2 * (b - a))::bigint), '' ORDER BY a) AS k
  FROM pieces p JOIN raw ON raw.doc_id = p.doc_id GROUP BY p.doc_id
), gone AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM islands GROUP BY doc_id
)
SELECT raw.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM raw JOIN kept ON kept.doc_id = raw.doc_id LEFT JOIN gone ON gone.doc_id = raw.doc_id
"""

# Sets as rows, overlaps by a join on shingles, and the smallest document that links reach.
NGRAM_JOIN = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * o >= 80 * (p.n + q.n - o)
), reach(x, y) AS (
  SELECT x, y FROM links
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce((SELECT min(y) FROM reach WHERE reach.x = d.doc_id), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""


def license_scan(base, more, per_slack: int, least: float) -> str:
    """Pairs of words joined to template places, and the longest chains of hits that rise in text and template inside a band."""
    rows = []
    for number, (phrase, label, is_base) in enumerate([(p, x, "true") for p, x in base] + [(p, x, "false") for p, x in more]):
        words = phrase.split(" ")
        rows += [
            f"({number}, '{label}', {is_base}, {len(words) - 1}, {i}, '{words[i]} {words[i + 1]}')" for i in range(len(words) - 1)
        ]
    return f"""
WITH RECURSIVE templates(template, label, is_base, pairs, spot, gram) AS (VALUES {", ".join(rows)}
), worded AS (
  SELECT doc_id, md5(coalesce(text, '')) AS k,
         regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), grams AS (
  SELECT DISTINCT doc_id, k, i - 1 AS place, w[i] || ' ' || w[i + 1] AS gram
  FROM (SELECT doc_id, k, w, unnest(range(1, greatest(len(w), 1))) AS i FROM worded)
), voted AS (
  SELECT doc_id, k, template, label, is_base, pairs, place - spot AS diagonal, bit_or(1::BIGINT << spot) AS mask
  FROM grams JOIN templates USING (gram) GROUP BY ALL
), places AS (
  SELECT doc_id, k, count(*) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS base_labels
  FROM voted WHERE is_base AND bit_count(mask) = pairs GROUP BY doc_id, k
), hits AS (
  SELECT doc_id, k, template, pairs, place, spot FROM grams JOIN templates USING (gram)
), chains(doc_id, k, template, pairs, band, place, spot, n) AS (
  SELECT h.doc_id, h.k, h.template, h.pairs, v.diagonal, h.place, h.spot, 1
  FROM hits h JOIN voted v ON v.doc_id = h.doc_id AND v.k = h.k AND v.template = h.template
       AND h.place - h.spot BETWEEN v.diagonal AND v.diagonal + 1 + v.pairs // {per_slack}
  UNION
  SELECT c.doc_id, c.k, c.template, c.pairs, c.band, h.place, h.spot, c.n + 1
  FROM chains c JOIN hits h ON h.doc_id = c.doc_id AND h.k = c.k AND h.template = c.template
       AND h.place - h.spot BETWEEN c.band AND c.band + 1 + c.pairs // {per_slack} AND h.place > c.place AND h.spot > c.spot
), merged AS (
  SELECT c.doc_id, c.k, label, max(n) / any_value(c.pairs) AS similarity
  FROM chains c JOIN (SELECT DISTINCT template, label FROM templates) USING (template) GROUP BY c.doc_id, c.k, c.template, c.band, label
), found AS (
  SELECT doc_id, k, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(similarity) AS score
  FROM merged WHERE similarity >= {least} GROUP BY doc_id, k
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM worded w LEFT JOIN places p ON p.doc_id = w.doc_id AND p.k = w.k LEFT JOIN found f ON f.doc_id = w.doc_id AND f.k = w.k
"""


def url_templates(rules, depth: int, fan: int, share: float, prior: float, block: float, alike: float) -> str:
    """Rules by length, then templates level by level, smoothed purities, and branches merged by a likelihood ratio."""
    cases = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{rule: '{h + p}', verdict: '{v}'}}"
        for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1]))
    )
    names = [f"s{i}" for i in range(depth)]
    # The last segment holds the rest of the path.
    cut = ", ".join(
        f"CASE WHEN plain = '' THEN NULL WHEN len(c) > {depth} AND {i} = {depth - 1} THEN array_to_string(c[{depth}:], '/') ELSE c[{i + 1}] END AS s{i}"
        for i in range(depth)
    )
    levels, tree = "", "nodes"
    for i, s in enumerate(names):
        levels += f""", kinds{i} AS (
  SELECT host, t, {s}, sum(n) AS k FROM {tree} WHERE {s} IS NOT NULL GROUP BY ALL
), rare{i} AS (
  SELECT host, t, {s} FROM kinds{i} JOIN (SELECT host, t, count(*) AS fan, sum(k) AS everything FROM kinds{i} GROUP BY ALL) p USING (host, t)
  WHERE fan > {fan} AND k < {share} * everything
), tree{i} AS (
  SELECT x.* EXCLUDE (t), CASE WHEN x.{s} IS NULL THEN x.t ELSE x.t || '/' || if(r.{s} IS NULL, x.{s}, '*') END AS t
  FROM {tree} x LEFT JOIN rare{i} r ON r.host = x.host AND r.t = x.t AND r.{s} = x.{s}
)"""
        tree = f"tree{i}"

    def purity(base):
        return f"((blocked + {prior} * {base}) / (labelled + {prior}))"

    def likelihood(some, all_of):
        parts = (f"CASE WHEN {x} > 0 THEN {x} * ln({x} / {all_of}) ELSE 0 END" for x in (some, f"({all_of} - {some})"))
        return f"({' + '.join(parts)})"

    same = " AND ".join(f"r.{s} IS NOT DISTINCT FROM j.{s}" for s in names)
    return f"""
WITH rests AS (
  SELECT page_id, coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages
), hosts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), {LETTERS}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests
), fitted AS (
  SELECT *, CASE {cases} END AS fit, regexp_replace(regexp_replace(path, '[0-9]+', '#', 'g'), '^/+|/+$', '', 'g') AS plain FROM hosts
), splits AS (
  SELECT *, string_split_regex(plain, '/+') AS c FROM fitted
), urls AS (
  SELECT page_id, host, path, fit.rule AS rule, fit.verdict AS verdict, {cut} FROM splits
), nodes AS (
  SELECT host, {", ".join(names)}, count(*) AS n, count(rule) AS labelled, count(*) FILTER (WHERE verdict = 'block') AS blocked, '' AS t
  FROM urls GROUP BY host, {", ".join(names)}
){levels}, single AS (
  SELECT host, t, sum(labelled) AS labelled, sum(blocked) AS blocked,
         CASE WHEN len(string_split(host, '.')) > 2 THEN array_to_string(string_split(host, '.')[-2:], '.') ELSE host END AS domain
  FROM {tree} GROUP BY host, t
), by_host AS (
  SELECT host, domain, sum(labelled) AS labelled, sum(blocked) AS blocked FROM single GROUP BY ALL
), by_domain AS (
  SELECT domain, sum(labelled) AS labelled, sum(blocked) AS blocked FROM by_host GROUP BY ALL
), base AS (
  SELECT {purity("0.5")} AS base FROM (SELECT sum(labelled) AS labelled, sum(blocked) AS blocked FROM by_domain)
), domain_purities AS (
  SELECT domain, {purity("base")} AS domain_purity FROM by_domain, base
), host_purities AS (
  SELECT host, {purity("domain_purity")} AS host_purity FROM by_host JOIN domain_purities USING (domain)
), branches AS (
  SELECT *, regexp_extract(t, '^(.*)/[^/]*$', 1) AS parent, regexp_extract(t, '(\\.[a-z]+)?$', 1) AS shape,
         CASE WHEN labelled > 0 THEN blocked / labelled END AS share
  FROM single JOIN host_purities USING (host)
), beside AS (
  SELECT *, lag(blocked) OVER siblings AS b0, lag(labelled) OVER siblings AS n0 FROM branches
  WINDOW siblings AS (PARTITION BY host, parent, shape ORDER BY share NULLS LAST, t)
), tested AS (
  SELECT *, labelled > 0 AND coalesce(2 * ({likelihood("blocked", "labelled")} + {likelihood("b0", "n0")}
            - {likelihood("(blocked + b0)", "(labelled + n0)")}), 0) >= {alike} AS opens FROM beside
), numbered AS (
  SELECT *, sum(opens::INT) OVER (PARTITION BY host, parent, shape ORDER BY share NULLS LAST, t) AS number FROM tested
), counted AS (
  SELECT *, max(number) FILTER (WHERE labelled > 0) OVER (PARTITION BY host, parent, shape) AS groups FROM numbered
), scored AS (
  SELECT *, parent || '/~' || shape || ' ' || CASE WHEN labelled > 0 OR groups = 0 THEN CAST(number AS VARCHAR) ELSE '-' END AS merged
  FROM counted
), merged AS (
  SELECT host, merged, {purity("host_purity")} AS score
  FROM (SELECT host, merged, any_value(host_purity) AS host_purity, sum(labelled) AS labelled, sum(blocked) AS blocked
        FROM scored GROUP BY host, merged)
), judged AS (
  SELECT x.host, {", ".join("x." + s for s in names)}, scored.merged, merged.score
  FROM {tree} x JOIN scored ON scored.host = x.host AND scored.t = x.t JOIN merged ON merged.host = x.host AND merged.merged = scored.merged
)
SELECT r.page_id, r.host, r.path, r.rule, coalesce(r.verdict, if(score >= {block}, 'block', 'allow')) AS verdict,
       j.merged AS template, CAST(score AS DOUBLE) AS score
FROM urls r LEFT JOIN judged j ON r.host = j.host AND {same}
"""


def pareto_mixing(weights, most: int, seed: int) -> str:
    """Water level over sources in the order of cap by weight, that over sizes, and running words in the order of Pareto ranks."""
    weight = "[" + ", ".join(f"{float(w)}" for w in weights) + "]"
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM sized GROUP BY source
), capped AS (
  SELECT *, {weight}[turn % {len(weights)} + 1] AS weight, source_size * {float(most)}::DOUBLE AS cap FROM sources
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER turns, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER turns, 0)) AS level
  FROM capped WINDOW turns AS (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), final AS (
  SELECT arg_min(level, (cap / weight, turn)) AS level FROM levels WHERE cap / weight >= level
), goals AS (
  SELECT source, source_size, least(cap, coalesce(weight * final.level, cap)) AS target,
         CASE WHEN source_size > 0 THEN least(cap, coalesce(weight * final.level, cap)) / source_size ELSE 0 END AS ratio
  FROM levels, final
), rests AS (
  SELECT *, floor(ratio) AS copies, CAST(round(target - floor(ratio) * source_size) AS BIGINT) AS rest FROM goals
), kinds AS (
  SELECT g.source, size, rest, CAST(count(*) AS HUGEINT) * size AS words, CAST(count(*) AS HUGEINT) * size * size AS square
  FROM sized s JOIN rests g ON s.source IS NOT DISTINCT FROM g.source WHERE size > 0 GROUP BY g.source, size, rest
), trials AS (
  SELECT source, size, rest, sum(words) OVER (PARTITION BY source ORDER BY size DESC) - words AS above,
         sum(square) OVER (PARTITION BY source ORDER BY size) AS squares
  FROM kinds
), bounds AS (
  SELECT source, max(size) AS bound, arg_max(above, size) AS above, arg_max(squares, size) AS squares
  FROM trials WHERE (rest - above) * size <= squares GROUP BY source
), ranked AS (
  SELECT s.doc_id, s.source, size, source_size, target, copies, rest,
         CASE WHEN size = 0 OR rest <= 0 THEN 0 WHEN size > bound THEN 1
              ELSE least(CAST(rest - above AS DOUBLE) * size / CAST(squares AS DOUBLE), 1) END AS p,
         (CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5) / {float(1 << 52)}::DOUBLE AS u
  FROM sized s JOIN rests g ON s.source IS NOT DISTINCT FROM g.source LEFT JOIN bounds b ON s.source IS NOT DISTINCT FROM b.source
), ordered AS (
  SELECT *, CASE WHEN p >= 1 THEN 0 WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank FROM ranked
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM ordered
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(copies * size + CASE WHEN p > 0 THEN greatest(0, least(size, rest - before)) ELSE 0 END AS BIGINT) AS taken
FROM placed
"""


def vector_codes(parts: int, entries: int, rounds: int, scale: int) -> str:
    """All distances of all parts to all entries, the least by distance and index, and floored means."""
    nearest = """
near{k} AS (
  SELECT vec_id, label, p, v, arg_min(e, (apart, e)) AS e, min(apart) AS apart
  FROM (SELECT x.*, y.e, list_sum([(x.v[i] - y.v[i]) * (x.v[i] - y.v[i]) FOR i IN range(1, len(x.v) + 1)]) AS apart
        FROM parts x JOIN book{k} y USING (p)) GROUP BY vec_id, label, p, v
)"""
    moved = """
book{k} AS (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{j} b LEFT JOIN (
    SELECT p, e, list((s - (s % n + n) % n) // n ORDER BY i) AS v
    FROM (SELECT p, e, i, CAST(sum(c) AS BIGINT) AS s, count(*) AS n
          FROM (SELECT p, e, unnest(v) AS c, unnest(range(len(v))) AS i FROM near{j}) GROUP BY p, e, i) GROUP BY p, e
  ) m ON m.p = b.p AND m.e = b.e
)"""
    steps = nearest.format(k=0) + "".join("," + moved.format(k=k, j=k - 1) + "," + nearest.format(k=k) for k in range(1, rounds + 1))
    return f"""
WITH kept AS (
  SELECT vec_id, label, [CAST(floor({scale} * x) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), parts AS (
  SELECT vec_id, label, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS v
  FROM (SELECT *, unnest(range({parts})) AS p FROM kept)
), book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v
  FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries})
), {steps.lstrip()}, coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(apart) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id, label
), books AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, books
"""


# CRC-32 bit by bit; a tree per source, level by level; a path per leaf, folded level by level.
_FIELD = "CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c} END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c=c) for c in ("doc_id", "source", "lang", "n_chars", "{t}")) + ")"
MERKLE_MANIFEST = f"""
WITH RECURSIVE marked AS (
  SELECT *, list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')],
    lambda crc, x: list_reduce([xor(crc, x)] || CAST(range(8) AS BIGINT[]), lambda c, i: xor(c // 2, (c % 2) * 3988292384))) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree, {_LEAF.format(t="text")} AS leaf,
         CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN {_LEAF.format(t="replace(text, chr(10), '')")} ELSE {_LEAF.format(t="text")} END AS other
  FROM marked
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves
), up(tree, level, pos, n, h) AS (
  SELECT tree, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 3, (max(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY tree, level, pos // 3
), subroots AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS top, count(*) OVER () AS n_tops FROM up WHERE n = 1
), tops(level, pos, n, h) AS (
  SELECT 0, top, n_tops, subroot FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (max(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 3
), nodes AS (
  SELECT tree, level, pos, h FROM up WHERE n > 1
  UNION ALL
  SELECT ' ', level, pos, h FROM tops WHERE n > 1
), steps AS (
  SELECT x.tree, x.level, x.pos, coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS l,
         coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS r
  FROM nodes x JOIN nodes y ON y.tree = x.tree AND y.level = x.level AND y.pos // 3 = x.pos // 3 GROUP BY ALL
), ways AS (
  SELECT p.doc_id, p.tree, p.pos, s.level, l, r FROM placed p JOIN steps s ON s.tree = p.tree AND s.pos = p.pos // CAST(pow(3, s.level) AS BIGINT)
  UNION ALL
  SELECT p.doc_id, p.tree, p.pos, 1000 + s.level, l, r
  FROM placed p JOIN subroots o ON o.tree = p.tree JOIN steps s ON s.tree = ' ' AND s.pos = o.top // CAST(pow(3, s.level) AS BIGINT)
), paths AS (
  SELECT tree, pos, sha256(string_agg(l || r, '' ORDER BY level)) AS proof, list(l ORDER BY level) AS ls, list(r ORDER BY level) AS rs
  FROM ways GROUP BY tree, pos
), fold(tree, pos, k, h) AS (
  SELECT tree, pos, 1, other FROM placed
  UNION ALL
  SELECT f.tree, f.pos, k + 1, sha256(ls[k] || h || rs[k]) FROM fold f JOIN paths p ON p.tree = f.tree AND p.pos = f.pos WHERE k <= len(ls)
), ends AS (
  SELECT tree, pos, arg_max(h, k) AS folded_root FROM fold GROUP BY tree, pos
), root AS (
  SELECT h AS root FROM tops WHERE n = 1
)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed p JOIN subroots USING (tree) JOIN ends e ON e.tree = p.tree AND e.pos = p.pos
     LEFT JOIN paths w ON w.tree = p.tree AND w.pos = p.pos, root
"""
