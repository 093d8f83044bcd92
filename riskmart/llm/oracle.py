"""The same results as SQL, where SQL can express them."""

from __future__ import annotations

# Lower-case words of a text as an array, as benchmark decontamination takes them.
_PLAIN = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_PLAIN}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LLM_ORACLE: dict[str, str] = {}

LLM_ORACLE["op8_decontamination"] = f"""
WITH item AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS run
    FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT n FROM windows),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
words AS (SELECT r, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM doc),
runs AS (
    SELECT r, i, n, string_agg(w, ' ') OVER s AS run, count(*) OVER s AS m
    FROM words, sizes
    WINDOW s AS (PARTITION BY n, r ORDER BY i ROWS BETWEEN CURRENT ROW AND n - 1 FOLLOWING)
),
found AS (SELECT r, i, n, item_id FROM runs JOIN windows USING (n, run) WHERE m = n),
hit AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM found, unnest(range(n)) AS u(k) GROUP BY r),
items AS (
    SELECT r, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM found GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

_BITS = "".join(f"{n:04b}" for n in range(16))
_NIBBLES = f"lambda c: substr('{_BITS}', 4 * strpos('0123456789abcdef', c) - 3, 4)"
_FIVE = " + ".join(f"substr(bits, 5 * i + {k + 1}, 1)::INTEGER * {16 >> k}" for k in range(5))

LLM_ORACLE["op1_warc"] = f"""
WITH page AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
hashed AS (
    SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h,
           array_to_string(list_transform(string_split(sha1(html), ''), {_NIBBLES}), '') AS bits
    FROM page
),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM hashed)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32),
           lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', {_FIVE} + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""

# Shingles of four words, exact overlaps of all pairs that share one, and their components.
LLM_ORACLE["op7_jaccard"] = f"""
WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all({_PLAIN}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
words AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i, len(w) AS n FROM doc),
runs AS (
    SELECT doc_id, n, string_agg(w, ' ') OVER s AS run, count(*) OVER s AS m
    FROM words
    WINDOW s AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)
),
shingle AS (SELECT DISTINCT doc_id, run FROM runs WHERE m = least(n, 4)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1),
overlap AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingle a JOIN shingle b ON a.run = b.run AND a.doc_id < b.doc_id GROUP BY 1, 2
),
link AS (
    SELECT a, b FROM overlap JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common >= 85 * (x.n + y.n - common)
),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(reach.b) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.a = doc_id GROUP BY doc_id, n
"""

_WORDS = "len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'))"
LLM_ORACLE["op9_token_rollup"] = f"""
WITH standing AS (
    SELECT source, lang, coalesce(text, '') AS t,
           doc_id IN (SELECT doc_id FROM labels WHERE quality = 0 AND doc_id IS NOT NULL) AS poor
    FROM documents
    WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)
),
entry AS (
    SELECT source, lang, 'words-1' AS tokenizer, {_WORDS} AS n
    FROM (SELECT source, lang, CASE WHEN poor THEN regexp_replace(t, '[0-9]+', ' ', 'g') ELSE t END AS t FROM standing)
    UNION ALL
    SELECT source, lang, 'runs-1', len(regexp_extract_all(t, '[A-Za-z0-9]+')) FROM standing
)
SELECT source, lang, tokenizer, count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_tokens
FROM entry GROUP BY ALL
"""


def _located(kind: str, order: int, pattern: str, keep: str) -> str:
    """Matches of one kind with their places, from the texts between them."""
    p = pattern.replace("'", "''")
    return f"""
    SELECT r, '{kind}' AS kind, {order} AS ord, start, start + length(v) AS stop, v FROM (
        SELECT r, v, (sum(length(g)) OVER upto + sum(length(v)) OVER upto - length(v))::BIGINT AS start
        FROM (SELECT r, unnest(m) AS v, unnest(g[1:len(m)]) AS g, generate_subscripts(m, 1) AS i FROM (
            SELECT r, regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS g FROM doc
        ))
        WINDOW upto AS (PARTITION BY r ORDER BY i)
    ) WHERE {keep}"""


def _spelt(of: str) -> str:
    return f"coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord){of}, '')"


_ASSIGN = (
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_KEPT_ASSIGN = "length(regexp_extract(v, '" + _ASSIGN.replace("'", "''") + "', 1)) >= 12"
_SECRETS = [
    ("assign", _ASSIGN, _KEPT_ASSIGN),
    ("access", "AKIA[A-Z0-9]+", "length(v) >= 18"),
    ("hex", "[0-9a-f]+", "length(v) >= 16"),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", "true"),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", "true"),
    ("google", "AIza[0-9A-Za-z_-]{35}", "true"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", "true"),
    ("pem", "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", "true"),
]

LLM_ORACLE["op10_secrets"] = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
span AS ({" UNION ALL ".join(_located(k, i, p, keep) for i, (k, p, keep) in enumerate(_SECRETS))})
SELECT doc_id, count(*) FILTER (kind = 'assign')::BIGINT AS n_assign, count(*) FILTER (kind = 'access')::BIGINT AS n_access,
       count(*) FILTER (kind = 'hex')::BIGINT AS n_hex, sha256({_spelt(" FILTER (ord < 3)")}) AS base_sha256,
       {_spelt("")} AS spans
FROM doc LEFT JOIN span USING (r) GROUP BY r, doc_id
"""

_LUHN = (
    "(list_sum(list_transform(range(1, 11), lambda i: "
    "substr(translate(lpad(d, 20, '0'), '0123456789', '0246813579'), 2 * i - 1, 1)::INTEGER"
    " + substr(lpad(d, 20, '0'), 2 * i, 1)::INTEGER)) % 10 = 0)"
)
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "list_max(list_transform(string_split(v, '.'), lambda x: x::HUGEINT)) <= 255"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 12 AND 19 AND {_LUHN.replace('lpad(d', f'lpad({_DIGITS}')}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
]

LLM_ORACLE["op5_pii"] = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
span AS ({" UNION ALL ".join(_located(k, i, p, keep) for i, (k, p, keep) in enumerate(_PII))}),
word AS ({_located("word", 0, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "true")}),
term AS (
    SELECT r, start, stop, translate(v, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM word
),
near AS (
    SELECT DISTINCT s.r, s.kind || ':' || s.v AS entity, t.term, t.start, t.stop
    FROM span s JOIN term t ON s.r = t.r
    WHERE ((t.stop <= s.start AND t.start >= s.start - 48) OR (t.start >= s.stop AND t.stop <= s.stop + 48))
      AND NOT EXISTS (SELECT 1 FROM span o WHERE o.r = t.r AND o.start < t.stop AND t.start < o.stop)
),
c_et AS (SELECT entity, term, count(DISTINCT r) AS c_et FROM near GROUP BY ALL HAVING c_et >= 3),
c_e AS (SELECT kind || ':' || v AS entity, count(DISTINCT r) AS c_e FROM span GROUP BY 1),
c_t AS (SELECT term, count(DISTINCT r) AS c_t FROM term GROUP BY 1),
rated AS (
    SELECT entity, term, ln(n * c_et / (c_e * c_t)) / ln(n / c_e) AS strength
    FROM c_et JOIN c_e USING (entity) JOIN c_t USING (term), (SELECT count(*)::DOUBLE AS n FROM doc) WHERE c_e < n
),
revealing AS (
    SELECT r, start, stop, min(CASE WHEN strength >= 0.95 THEN 4 ELSE 5 END) AS ord
    FROM near JOIN rated USING (entity, term) WHERE strength >= 0.8 GROUP BY ALL
),
every AS (
    SELECT r, kind, ord, start, stop FROM span
    UNION ALL SELECT r, CASE ord WHEN 4 THEN 'remove' ELSE 'generalise' END, ord, start, stop FROM revealing
)
SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}')::BIGINT AS n_{k}" for k, _, _ in _PII)},
       sha256({_spelt(" FILTER (ord < 4)")}) AS base_sha256, {_spelt("")} AS spans
FROM doc LEFT JOIN every USING (r) GROUP BY r, doc_id
"""
