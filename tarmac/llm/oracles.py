"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

URL_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parsed AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
), rules (rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(verdict, 'allow') AS verdict
FROM parsed
LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) = 1
"""

TOP_K_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id::BIGINT AS query_id, c.vec_id::BIGINT AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""

MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sums AS (
  SELECT source, sum(size)::HUGEINT AS s FROM sized GROUP BY source
), placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sums
), weighed AS (
  SELECT *, (place % 3 + 1)::HUGEINT AS w FROM placed
), ordered AS (  -- sources reach their cap in the order of cap / weight
  SELECT *, sum(s) OVER () - 3 * coalesce(sum(s) OVER before, 0) AS left_size, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS left_weight
  FROM weighed
  WINDOW before AS (ORDER BY s::DOUBLE / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), capped AS (
  SELECT *, 3 * s * left_weight <= w * left_size AS full_ FROM ordered
), level AS (
  SELECT sum(s) - 3 * coalesce(sum(s) FILTER (full_), 0) AS num, coalesce(sum(w) FILTER (NOT full_), 0) AS den FROM capped
), targets AS (
  SELECT source, s, place, CASE WHEN full_ THEN (3 * s)::DOUBLE ELSE (w * num)::DOUBLE / den::DOUBLE END AS target
  FROM capped, level
), numbered AS (
  SELECT sized.*, s, target, place, size * 64 > s AS heavy,
         ((place + 1) * 668265263 % 1048576) / 1048576.0::DOUBLE AS u,
         CASE WHEN s > 0 THEN target / s::DOUBLE ELSE 0::DOUBLE END AS e,
         row_number() OVER (PARTITION BY sized.source ORDER BY size, doc_id NULLS LAST) - 1 AS i,
         count(*) OVER (PARTITION BY sized.source) AS n
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), first_ AS (
  SELECT *, (size * least(3, floor((n - i) * e + u) - floor((n - 1 - i) * e + u)))::BIGINT AS taken_first FROM numbered
), rest AS (
  SELECT place, coalesce(sum(taken_first) FILTER (heavy), 0) AS taken_, coalesce(sum(size) FILTER (NOT heavy), 0) AS light
  FROM first_ GROUP BY place
), shares AS (
  SELECT first_.*, CASE WHEN light > 0 THEN least(3::DOUBLE, greatest(0::DOUBLE, (target - taken_::DOUBLE) / light::DOUBLE)) ELSE 0::DOUBLE END AS r
  FROM first_ JOIN rest USING (place)
)
SELECT doc_id, size, s::BIGINT AS source_size, target,
       CASE WHEN heavy THEN taken_first ELSE (size * least(3, floor((i + 1) * r + u) - floor(i * r + u)))::BIGINT END AS taken
FROM shares
"""


def _spans_sql() -> str:
    """One query per kind: gaps and hits of the pattern, places from the sums of their lengths, then the check."""
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = (
        "list_sum(list_transform(range(1, length(d) + 1), lambda i: (substr(d, length(d) - i + 1, 1)::INT * (2 - i % 2))"
        " - CASE WHEN i % 2 = 0 AND substr(d, length(d) - i + 1, 1)::INT > 4 THEN 9 ELSE 0 END)) % 10 = 0"
    )
    letters = "list_transform(string_split(substr(m, 5) || substr(m, 1, 4), ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)"
    mod97 = f"list_reduce(list_prepend(0, {letters}), lambda a, v: (a * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1"
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", 60, "e-?mail|mail|contact|write|reach|kontakt|schreiben|courriel|contacter|correo|escribir"),
        (
            "ip",
            r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
            "list_bool_and(list_transform(string_split(m, '.'), lambda p: length(ltrim(p, '0')) <= 3 AND ('0' || right(p, 3))::INT <= 255))",
            50,
            "ip|host|server|address|login|adresse|rechner|serveur|servidor|direccion",
        ),
        (
            "card",
            r"[0-9](?:[\x20-]?[0-9])+",
            f"CASE WHEN length({digits}) BETWEEN 16 AND 19 THEN {luhn} ELSE false END",
            70,
            "card|visa|payment|credit|pay|karte|kreditkarte|zahlung|carte|paiement|tarjeta|pago",
        ),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({digits}) BETWEEN 8 AND 15", 50, "phone|call|tel|mobile|fax|telefon|anruf|telephone|appeler|telefono|llamar|movil"),
        (
            "iban",
            "[A-Za-z0-9]{15,}",
            f"CASE WHEN regexp_full_match(m, '[A-Z][A-Z][0-9][0-9][A-Z0-9]+') AND length(m) <= 34 THEN {mod97} ELSE false END",
            60,
            "iban|account|bank|transfer|konto|compte|banque|virement|cuenta|banco|transferencia",
        ),
        ("ssn", "[0-9][0-9-]*", "regexp_full_match(m, '[0-9]{3}-[0-9]{2}-[0-9]{4}')", 30, "ssn|social security|tax id|steuernummer|securite sociale|seguridad social"),
    ]
    parts = []
    for order, (kind, pattern, check, score, words) in enumerate(kinds):
        parts.append(f"""
  SELECT doc_id, {order} AS kind_order, '{kind}' AS kind, place AS start_, place + length(m) AS end_,
         CASE WHEN regexp_matches(substr(text, greatest(1, place + 1 - 40), least(40, place)), '(?i)(?:^|[^a-z])(?:{words})(?:[^a-z]|$)')
              THEN least(100, {score} + 30) ELSE {score} END AS score
  FROM (
    SELECT doc_id, text, m, {digits} AS d,
           (list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0))::BIGINT AS place
    FROM (
      SELECT *, unnest(hits) AS m, unnest(range(1, len(hits) + 1)) AS i
      FROM (SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS hits, regexp_split_to_array(text, '{pattern}') AS gaps
            FROM texts)
    )
  ) WHERE {check}""")
    return " UNION ALL ".join(parts)


PII_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), spans AS (
  SELECT * FROM ({_spans_sql()}) WHERE kind_order < 4 OR score >= 50
), listed AS (
  SELECT doc_id,
         count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(concat_ws(':', kind, start_, end_), ',' ORDER BY kind_order, start_) FILTER (kind_order < 4) AS base,
         string_agg(concat_ws(':', kind, start_, end_), ',' ORDER BY kind_order, start_) AS spans,
         string_agg(concat_ws(':', kind, start_, end_, score), ',' ORDER BY kind_order, start_) AS scored_spans
  FROM spans GROUP BY doc_id
)
SELECT texts.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(scored_spans, '') AS scored_spans
FROM texts LEFT JOIN listed USING (doc_id)
"""


def _leaf_sql(*fields: str) -> str:
    parts = (f"coalesce(strlen({f}::VARCHAR)::VARCHAR || ':' || {f}::VARCHAR, '-')" for f in fields)
    return f"sha256({' || '.join(parts)})"


_CRC_STEP = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
_CRC32 = (
    "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)), "
    f"lambda a, b: {_CRC_STEP}), 4294967295)"
)

MERKLE_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS place,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos,
         {_leaf_sql("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
         CASE WHEN {_CRC32} % 2 = 0 THEN {_leaf_sql("doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')")}
              ELSE {_leaf_sql("doc_id", "source", "lang", "n_chars", "text")} END AS now
  FROM documents
), tree AS (
  SELECT place, 0::BIGINT AS level, pos, leaf AS node, count(*) OVER (PARTITION BY place) AS n FROM leaves
  UNION ALL
  SELECT place, level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3
  FROM tree WHERE n > 1 GROUP BY place, level, pos // 3, n
), crown AS (
  SELECT 0::BIGINT AS level, place AS pos, node, count(*) OVER () AS n FROM tree WHERE n = 1
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3 FROM crown WHERE n > 1 GROUP BY level, pos // 3, n
), heights AS (
  SELECT place, max(level) AS height FROM tree GROUP BY place
), steps AS (
  SELECT l.place, l.pos, t.level AS step, t.pos AS other, t.node, l.pos // (3 ** t.level)::BIGINT AS own
  FROM leaves l JOIN tree t ON t.place = l.place AND t.n > 1 AND t.pos // 3 = l.pos // (3 ** (t.level + 1))::BIGINT
  UNION ALL
  SELECT l.place, l.pos, height + c.level, c.pos, c.node, l.place // (3 ** c.level)::BIGINT
  FROM leaves l JOIN heights USING (place) JOIN crown c ON c.n > 1 AND c.pos // 3 = l.place // (3 ** (c.level + 1))::BIGINT
), segments AS (
  SELECT place, pos, step, coalesce(string_agg(node, '' ORDER BY other) FILTER (other < own), '') AS ahead,
         coalesce(string_agg(node, '' ORDER BY other) FILTER (other > own), '') AS behind
  FROM steps GROUP BY place, pos, step
), folds AS (
  SELECT place, pos, 0::BIGINT AS step, now AS node FROM leaves
  UNION ALL
  SELECT f.place, f.pos, f.step + 1, sha256(ahead || node || behind) FROM folds f JOIN segments s USING (place, pos, step)
), folded AS (
  SELECT place, pos, arg_max(node, step) AS folded_root FROM folds GROUP BY place, pos
), proofs AS (
  SELECT place, pos, sha256(string_agg(ahead || behind, '' ORDER BY step)) AS proof_sha256 FROM segments GROUP BY place, pos
), apex AS (
  SELECT node AS root FROM crown WHERE n = 1
)
SELECT doc_id, leaf, t.node AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN tree t ON t.place = leaves.place AND t.n = 1 JOIN folded f ON f.place = leaves.place AND f.pos = leaves.pos
LEFT JOIN proofs p ON p.place = leaves.place AND p.pos = leaves.pos, apex
"""

_TERM_LIST = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

LEXICAL_SQL = f"""
WITH listed AS (
  SELECT row_number() OVER () AS doc, doc_id, {_TERM_LIST} AS terms FROM documents
), totals AS (
  SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM listed
), held AS (
  SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM listed) GROUP BY doc, term
), asked AS (
  SELECT item, item_id, term, count(*) AS times
  FROM (SELECT item, item_id, unnest(terms) AS term
        FROM (SELECT row_number() OVER () AS item, item_id, {_TERM_LIST} AS terms FROM benchmark))
  GROUP BY item, item_id, term
), weighed AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, totals GROUP BY term, n_docs
), scored AS (
  SELECT item, item_id, l.doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(l.terms) * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weighed USING (term) JOIN held USING (term) JOIN listed l USING (doc), totals
  GROUP BY item, item_id, l.doc, l.doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
