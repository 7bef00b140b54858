"""DuckDB SQL of the operators that SQL can express."""

from lodgestar.llm.url_filter import SOFT_TERMS, STRICT_TERMS

_WORDS = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH words AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0)::BIGINT AS size,
        length(text) AS chars
    FROM documents
), draws AS (
    SELECT doc_id, source, size,
        -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || 'mix'), 1, 13))::UBIGINT::DOUBLE + 0.5)
            / 4503599627370496.0)
        / CASE WHEN size > 0 AND (chars < size * 3 OR chars > size * 12) THEN 0.25 ELSE 1.0 END AS draw
    FROM words
), sized AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM draws GROUP BY source
), weighed AS (
    SELECT source, source_size, source_size * 3 AS most,
        1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
    FROM sized
), levels AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER soonest, 0))::DOUBLE
        / (sum(weight) OVER () - coalesce(sum(weight) OVER soonest, 0))::DOUBLE AS level
    FROM weighed
    WINDOW soonest AS (ORDER BY most::DOUBLE / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), aimed AS (
    SELECT source, source_size,
        least(most::DOUBLE, max(level) OVER () * weight) AS target
    FROM levels
), budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs
    FROM aimed
), placed AS (
    SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs,
        round(b.target - b.epochs * b.source_size)::BIGINT AS budget,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS used
    FROM draws d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
    (epochs * size + greatest(0, least(size, budget - used)))::BIGINT AS taken
FROM placed
"""

OP3 = """
WITH texts AS (
    SELECT doc_id, CASE WHEN length(text) > 0 THEN string_split(text, chr(10)) ELSE [] END AS lines
    FROM documents
), lines AS (
    SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM texts
), windows AS (
    SELECT doc_id, pos, line AS a,
        lead(line) OVER w AS b, lead(line, 2) OVER w AS c, lead(pos, 2) OVER w AS last
    FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), placed AS (
    SELECT doc_id, pos, first_value(doc_id) OVER same AS first_doc, first_value(pos) OVER same AS first_pos
    FROM windows WHERE last IS NOT NULL AND length(trim(a || b || c, ' ')) > 0
    WINDOW same AS (PARTITION BY a, b, c ORDER BY doc_id, pos)
), covered AS (
    SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM placed
    WHERE doc_id > first_doc OR pos >= first_pos + 3
), marked AS (
    SELECT l.doc_id, l.pos, l.line, c.pos IS NOT NULL AS gone
    FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.pos = c.pos
), counted AS (
    SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
        string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS kept
    FROM marked GROUP BY doc_id
)
SELECT t.doc_id, len(t.lines)::BIGINT AS n_lines, coalesce(c.n_removed, 0)::BIGINT AS n_removed,
    sha256(coalesce(c.kept, '')) AS kept_sha256
FROM texts t LEFT JOIN counted c ON t.doc_id = c.doc_id
"""


OP11 = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS member, a.label = b.label AS same,
        list_inner_product(a.q, b.q)::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, member AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, member) <= 5
), negatives AS (
    SELECT p.anchor_id, p.positive_id, s.member AS negative_id, p.positive_score,
        s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.member)
            ::INTEGER AS rank
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
        AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 3
"""


def _op12() -> str:
    beside = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"

    def count(terms: tuple[str, ...]) -> str:
        found = []
        for term in terms:
            words = term.replace(" ", r"[^0-9A-Za-z\x{80}-\x{10FFFF}]")
            pattern = f"(?s)(^|.*[^{beside[1:-1]}]){words}([^{beside[1:-1]}].*|$)"
            found.append(f"regexp_full_match(lowered, '{pattern}')::INTEGER")
        return " + ".join(found)

    rules = [
        ("allow", "org", "/"),
        ("block", "example.org", "/es/"),
        ("block", "example.org", "/en/1"),
        ("allow", "com", "/fr/"),
        ("block", "com", "/de/"),
    ]
    rows = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in rules)
    return f"""
WITH split AS (
    SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
            AS lowered,
        CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id, lowered,
        translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
    FROM split
), rules AS (
    SELECT * FROM (VALUES {rows}) AS r(verdict, host, path)
), judged AS (
    SELECT p.*, ({count(STRICT_TERMS)})::INTEGER AS strict, ({count(SOFT_TERMS)})::INTEGER AS soft,
        (SELECT arg_max(struct_pack(rule := r.host || r.path, verdict := r.verdict),
                length(r.host || r.path)) FROM rules r
            WHERE ('.' || p.host) LIKE ('%.' || r.host) AND starts_with(p.path, r.path)) AS best
    FROM parts p
)
SELECT page_id, host, path, best.rule AS rule,
    coalesce(best.verdict, CASE WHEN strict > 0 OR soft > 1 THEN 'block' ELSE 'allow' END) AS verdict,
    strict AS n_strict, soft AS n_soft
FROM judged
"""


OP12 = _op12()

OP13 = """
WITH digests AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), numbers AS (
    SELECT doc_id, text, length(text)::BIGINT AS n,
        ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
        ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
    FROM digests
), cuts AS (
    SELECT doc_id, text, n,
        CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
            OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
        least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b
    FROM numbers
), parts AS (
    SELECT *, left(text, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix
    FROM cuts
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""


def llm_oracle_sql() -> dict[str, str]:
    return {
        "op1_mixing": OP1,
        "op3_line_dedup": OP3,
        "op11_hard_negatives": OP11,
        "op12_url_filter": OP12,
        "op13_fim": OP13,
    }
