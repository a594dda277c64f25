"""DuckDB SQL with the results of the queries, written from the contracts and not from the operators."""

#: Each dialogue's messages once for each speaker; offsets are running sums of the rendered lengths.
CHAT_VIEWS = r"""
WITH said AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
view AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
seen AS (
    SELECT s.*, v.perspective, CASE WHEN speaker = 'system' THEN '<|system|>' WHEN speaker = perspective THEN '<|assistant|>' ELSE '<|user:' || speaker || '|>' END || chr(10) AS head
    FROM said s JOIN view v USING (conv_id)),
placed AS (
    SELECT *, head || text || '<|end|>' || chr(10) AS rendered, row_number() OVER o - 1 AS position,
        sum(length(head) + length(text) + 8) OVER o AS stop FROM seen
    WINDOW o AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, speaker, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, turn, position, speaker, rendered, CAST(stop - length(rendered) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop,
    speaker = perspective AS in_loss, CAST(CASE WHEN speaker = perspective THEN stop - length(rendered) + length(head) ELSE stop END AS BIGINT) AS mask_start,
    CAST(stop AS BIGINT) AS mask_stop
FROM placed
"""

#: Items and documents as words; windows joined by their words; hit words counted once each.
DECONTAMINATION = r"""
WITH item AS MATERIALIZED (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
    FROM benchmark),
win AS MATERIALIZED (
    SELECT DISTINCT item_id, w[i : i + least(len(w), 10) - 1] AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
    FROM documents),
sizes AS MATERIALIZED (SELECT DISTINCT len(win) AS n, win[1] AS first FROM win),
spot AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS first FROM doc),
place AS MATERIALIZED (
    SELECT s.doc_id, s.i, z.n, w[s.i : s.i + z.n - 1] AS win FROM spot s JOIN sizes z USING (first) WHERE s.i + z.n - 1 <= len(w)),
found AS MATERIALIZED (SELECT a.doc_id, a.i, a.n, v.item_id FROM place a JOIN win v USING (win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, coalesce(CAST(item_id AS VARCHAR), 'null') AS name FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
    sha256(coalesce(m.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN hit h USING (doc_id) LEFT JOIN named m USING (doc_id)
"""

#: Targets by a level that fills sources up to their caps, copies by a level within the source; extra copies in the order of Pareto ranks.
PARETO_MIX = r"""
WITH own AS MATERIALIZED (
    SELECT doc_id, source, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k, md5(coalesce(text, '')) AS h,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents),
doc AS MATERIALIZED (
    SELECT *, CAST(length(bin(size)) AS DOUBLE) AS x,
        CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || h || ':' || row_number() OVER (PARTITION BY doc_id, source, h)), 1, 12) AS BIGINT) AS bits
    FROM own),
src AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size FROM doc GROUP BY k),
weighted AS (SELECT *, CAST((row_number() OVER (ORDER BY k) - 1) % 3 + 1 AS DOUBLE) AS w, CAST(source_size AS DOUBLE) * 3 AS cap FROM src),
filled AS (
    SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
        / sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted),
target AS MATERIALIZED (
    SELECT k, source_size, round(least(cap, (SELECT max(level) FROM filled WHERE level <= cap / w) * w), 6) AS target FROM filled),
cell AS (SELECT k, x, sum(size) AS own, CAST(sum(size) AS DOUBLE) * 3 AS most, x * CAST(sum(size) AS DOUBLE) AS mass FROM doc GROUP BY k, x HAVING sum(size) > 0),
rising AS (
    SELECT cell.*, target, (target - coalesce(sum(most) OVER (PARTITION BY k ORDER BY x DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
        / sum(mass) OVER (PARTITION BY k ORDER BY x DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM cell JOIN target USING (k)),
expected AS (
    SELECT *, least(3.0::DOUBLE, coalesce(max(CASE WHEN level <= 3.0::DOUBLE / x THEN level END) OVER (PARTITION BY k), 3.0::DOUBLE / min(x) OVER (PARTITION BY k)) * x) AS e FROM rising),
parted AS MATERIALIZED (SELECT k, x, own, floor(e + 1e-9::DOUBLE) AS whole, greatest(e - floor(e + 1e-9::DOUBLE), 0.0) AS part FROM expected),
need AS (SELECT k, any_value(target) - sum(whole * own) AS need FROM parted JOIN target USING (k) GROUP BY k),
ranked AS MATERIALIZED (
    SELECT d.*, t.source_size, t.target, coalesce(p.whole, 0) AS whole, coalesce(p.part, 0) AS part, need, (bits + 0.5) / 281474976710656.0::DOUBLE AS u
    FROM doc d JOIN target t USING (k) LEFT JOIN parted p ON p.k = d.k AND p.x = d.x LEFT JOIN need n ON n.k = d.k),
placed AS (
    SELECT *, CASE WHEN part > 0 THEN floor((u / (1 - u) / (part / (1 - part))) / (1 + u / (1 - u) / (part / (1 - part))) * 281474976710656.0::DOUBLE) END AS place FROM ranked),
run AS (
    SELECT *, sum(size) OVER (PARTITION BY k, part > 0 ORDER BY place RANGE UNBOUNDED PRECEDING) AS upto, sum(size) OVER (PARTITION BY k, part > 0, place) AS same FROM placed)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM (
    SELECT *, CAST(whole AS BIGINT) + CASE WHEN part > 0 AND (upto < need OR (upto - same < need AND (need - (upto - same)) * 2 >= same)) THEN 1 ELSE 0 END AS copies FROM run)
"""


def pii_sql() -> str:
    """The patterns as the contract gives them, each kind's positions from the lengths of pieces and finds."""
    digits = "regexp_replace(v, '[^0-9]', '', 'g')"
    luhn = (
        f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr({digits}, -i, 1) AS INT) "
        f"ELSE CAST(substr({digits}, -i, 1) AS INT) * 2 - CASE WHEN CAST(substr({digits}, -i, 1) AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
    )
    letters = "list_transform(string_split(turned, ''), lambda c: CASE WHEN c BETWEEN 'A' AND 'Z' THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END)"
    turned = "substr(replace(v, ' ', ''), 5) || substr(replace(v, ' ', ''), 1, 4)"
    mod97 = f"list_reduce(list_prepend(0::HUGEINT, list_transform(string_split(array_to_string({letters.replace('turned', turned)}, ''), ''), lambda c: CAST(c AS HUGEINT))), lambda a, b: (a * 10 + b) % 97) = 1"
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", "mail|contact|write|send", 0.7, 1),
        ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "len(list_filter(string_split(v, '.'), lambda p: TRY_CAST(p AS HUGEINT) IS NULL OR TRY_CAST(p AS HUGEINT) > 255)) = 0", "ip|server|host|addr|login", 0.5, 1),
        ("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({digits}) BETWEEN 12 AND 19 AND {luhn}", "card|visa|credit|debit|payment", 0.7, 1),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({digits}) BETWEEN 9 AND 15", "phone|call|tel|mobile|fax", 0.6, 1),
        ("iban", r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b", mod97, "iban|account|bank|transfer", 0.7, 0),
        ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "NOT regexp_matches(v, '^(000|666|9)|-00-|-0000$')", "ssn|social|security", 0.4, 0),
    ]
    parts = []
    for place, (name, pattern, valid, context, score, base) in enumerate(kinds):
        parts.append(f"""
        SELECT doc_id, {place} AS kind, '{name}' AS name, {base} AS base, s AS start, s + length(v) AS stop,
            {score} + CASE WHEN regexp_matches(lower(right(p, 40) || ' ' || left(q, 40)), '{context}') THEN 0.3 ELSE 0.0 END AS score
        FROM (
            SELECT doc_id, v, p, q, length(p) + sum(length(p) + length(v)) OVER (PARTITION BY doc_id ORDER BY i) - length(p) - length(v) AS s
            FROM (
                SELECT doc_id, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS v, unnest(g[1 : len(m)]) AS p, unnest(g[2 : len(m) + 1]) AS q
                FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM doc WHERE regexp_matches(t, '{pattern}'))))
        WHERE {valid}""")
    every = " UNION ALL ".join(parts)
    return f"""
    WITH doc AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    every AS MATERIALIZED ({every}),
    kept AS MATERIALIZED (SELECT * FROM every WHERE base = 1 OR score >= 0.6),
    own AS (
        SELECT doc_id, count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip, count(*) FILTER (kind = 2) AS n_card, count(*) FILTER (kind = 3) AS n_phone,
            coalesce(string_agg(name || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, kind) FILTER (base = 1), '') AS base,
            string_agg(name || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, kind) AS spans, CAST(round(max(score), 2) AS DOUBLE) AS top
        FROM kept GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
        sha256(coalesce(o.base, '')) AS base_sha256, coalesce(o.spans, '') AS spans, coalesce(o.top, 0.0) AS top_score
    FROM doc d LEFT JOIN own o USING (doc_id)
    """

HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id AS vec_id, CAST(list_inner_product(a.e, r.e) AS BIGINT) AS score FROM v AS a JOIN v AS r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank", vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score QUALIFY "rank" <= 5
"""

COLLOCATIONS = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g FROM words, (VALUES (1), (2), (3)) AS t(k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL),
c AS (SELECT *, string_split(g, ' ') AS p FROM f WHERE k > 1 AND f >= 10),
cuts AS (SELECT lang, k, g, p, f, cut, array_to_string(p[1:cut], ' ') AS lg, array_to_string(p[cut + 1:], ' ') AS rg FROM c, (VALUES (1), (2)) AS t(cut) WHERE cut < k),
scored AS (SELECT cuts.lang, cuts.k, cuts.g, p, cuts.f AS a, a.f AS l, b.f AS r, CAST(CAST(1000000 AS HUGEINT) * cuts.f * cuts.f // (CAST(a.f AS HUGEINT) * b.f) AS BIGINT) AS score, cut
FROM cuts JOIN f AS a ON a.lang = cuts.lang AND a.g = lg JOIN f AS b ON b.lang = cuts.lang AND b.g = rg
QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.g ORDER BY score, cut) = 1),
inner_ AS (SELECT lang, unnest([array_to_string(p[1:2], ' '), array_to_string(p[2:3], ' ')]) AS g, a AS longer FROM scored WHERE k = 3),
most AS (SELECT lang, g, max(longer) AS longer FROM inner_ GROUP BY ALL),
kept AS (SELECT scored.* FROM scored LEFT JOIN most USING (lang, g) WHERE k = 3 OR longer IS NULL OR 100 * longer < 50 * a),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS INTEGER) AS "rank", g AS phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY "rank" <= 2000
"""
