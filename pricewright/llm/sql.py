"""DuckDB twins. Each starts from the given tables and shares no code with the operators."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"


def words(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), '{WORD}')"


def near_dup(source: str, width: int, percent: int = 80) -> str:
    """Components over links of at least ``percent`` / 100 similarity between sets of ``width``-word shingles."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE tokens AS (SELECT doc_id, {words(f"translate(text, '{upper}', '{lower}')")} AS w FROM {source}),
lists AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' '))) END AS s FROM tokens),
sets AS (SELECT doc_id, len(s)::BIGINT AS n_shingles, s FROM lists),
shingles AS (SELECT doc_id, n_shingles, unnest(s) AS shingle FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common, any_value(a.n_shingles) AS na, any_value(b.n_shingles) AS nb
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= {percent} * (na + nb - common)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
label AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept, class_id
FROM sets JOIN label ON doc_id = a JOIN (SELECT doc_id AS c, min(doc_id) OVER (PARTITION BY CASE WHEN s = [] THEN [doc_id::VARCHAR, ''] ELSE list_sort(s) END) AS class_id FROM sets) ON c = doc_id"""


def substring(source: str, width: int) -> str:
    """Words not covered by a window that also starts in a document with a smaller id."""
    return f"""
WITH tokens AS (SELECT doc_id, {words("text")} AS w FROM {source}),
windows AS (SELECT doc_id, unnest(range(1, len(w) - {width - 2})) AS i, unnest(list_transform(range(1, len(w) - {width - 2}), lambda i: md5(array_to_string(w[i:i + {width - 1}], ' ')))) AS h
    FROM tokens WHERE len(w) >= {width}),
firsts AS (SELECT h, min(doc_id) AS least FROM windows GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {width})) AS i FROM windows JOIN firsts USING (h) WHERE doc_id > least),
gone_lists AS (SELECT doc_id, list(i) AS g, count(*) AS n FROM gone GROUP BY doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ') ELSE coalesce(k, '') END) AS kept_sha256
FROM tokens t LEFT JOIN gone_lists USING (doc_id)
LEFT JOIN (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) AS k
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM tokens) x
    LEFT JOIN gone USING (doc_id, i) WHERE gone.i IS NULL GROUP BY x.doc_id) kept ON kept.doc_id = t.doc_id"""


def warc(source: str) -> str:
    """Digests, record types and the order of captures; base32 from the hexadecimal digest, five bits at a time."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    bits = "".join(f"WHEN '{i:x}' THEN '{i:04b}' " for i in range(16))
    return f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS body FROM {source}),
sums AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex FROM payloads),
binaries AS (SELECT page_id, payload_bytes, list_reduce([CASE substr(hex, i, 1) {bits}END FOR i IN range(1, 41)], lambda a, b: a || b) AS bits FROM sums),
digests AS (SELECT page_id, payload_bytes, list_reduce([substr('{letters}', 1 + (('0b' || substr(bits, 1 + 5 * i, 5))::INT), 1) FOR i IN range(0, 32)], lambda a, b: a || b) AS payload_digest FROM binaries),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM digests),
places AS (SELECT page_id, regexp_replace(regexp_replace(CASE WHEN coalesce(url, '') = '' THEN 'urn:page:' || page_id ELSE regexp_replace(url, '[\\x00-\\x20\\x7F]', '%20', 'g') END, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare,
  strftime(make_timestamp((1577836800 + page_id % 1000000000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS date FROM {source}),
parts AS (SELECT page_id, date, regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '(^www\\d*\\.)|(:\\d+$)', '', 'g') AS host, regexp_replace(bare, '^[^/?]*', '') AS rest FROM places),
keys AS (SELECT page_id, date, array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || CASE WHEN rest = '' THEN '/' ELSE rest END AS url_key FROM parts)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, row_number() OVER (ORDER BY url_key, date, page_id) - 1 AS position, url_key, date FROM firsts JOIN keys USING (page_id)"""


def mixing(source: str, rounds: int, temper: float, share: float) -> str:
    """Raking with as many rounds, one common table a step; the budget by filling the steepest cells first."""
    has = lambda *marks: "coalesce(" + " OR ".join(f"contains(text, '{m}')" for m in marks) + ", false)"
    steps = [f"""words AS (SELECT doc_id, source, lang AS language, text, len({words("text")})::BIGINT AS n_tokens FROM {source}),
rows AS MATERIALIZED (SELECT doc_id, source, language, n_tokens, CASE WHEN {has(" | ")} THEN 'table' WHEN {has("!!")} THEN 'shout'
  WHEN {has("###", "$$$", "%%%", "&&&", "***")} THEN 'markup' WHEN n_tokens < 100 THEN 'note' WHEN n_tokens < 1000 THEN 'article' ELSE 'long' END AS topic FROM words),
cells AS MATERIALIZED (SELECT source, language, topic, sum(n_tokens)::DOUBLE AS tokens FROM rows GROUP BY ALL)"""]
    for m in ("source", "language", "topic"):
        steps.append(f"t_{m} AS MATERIALIZED (SELECT {m}, x / sum(x) OVER () AS target_{m} FROM (SELECT {m}, pow(sum(tokens), {temper}) AS x FROM cells GROUP BY ALL))")
    steps.append("""w0 AS MATERIALIZED (SELECT c.*, tokens / sum(tokens) OVER () AS weight, target_source, target_language, target_topic FROM cells c
  JOIN t_source s ON c.source IS NOT DISTINCT FROM s.source JOIN t_language l ON c.language IS NOT DISTINCT FROM l.language JOIN t_topic t ON c.topic = t.topic)""")
    at = 0
    for _ in range(rounds):
        for m in ("source", "language", "topic"):
            at += 1
            steps.append(f"w{at} AS MATERIALIZED (SELECT * REPLACE (weight * target_{m} / sum(weight) OVER (PARTITION BY {m}) AS weight) FROM w{at - 1})")
    return "WITH " + ",\n".join(steps) + f""",
steep AS (SELECT tokens, weight, weight / tokens AS ratio, sum(tokens) OVER w AS used, sum(weight) OVER (ORDER BY weight / tokens, tokens ROWS UNBOUNDED PRECEDING) AS rest, sum(tokens) OVER () AS total
  FROM w{at} WHERE tokens > 0 AND weight > 0 WINDOW w AS (ORDER BY weight / tokens DESC, tokens DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (SELECT ({share} * total - coalesce(used, 0)) / rest AS budget, ratio FROM steep),
level AS (SELECT max(budget) FILTER (budget * ratio <= 1 + 1e-12) AS budget FROM filled),
rates AS (SELECT source, language, topic, round(weight, 12) AS weight, round(least(1.0, CASE WHEN tokens > 0 THEN coalesce(budget, 0) * (weight / tokens) ELSE 0 END), 10) AS probability FROM w{at}, level)
SELECT doc_id, r.source, r.language, r.topic, n_tokens, weight, probability,
  ('0x' || substr(md5('mix:' || doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE < probability AS sampled
FROM rows r JOIN rates c ON r.source IS NOT DISTINCT FROM c.source AND r.language IS NOT DISTINCT FROM c.language AND r.topic = c.topic"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, byte by byte with the table of the polynomial 0xEDB88320."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: xor(c >> 8, ({table}::BIGINT[])[1 + (xor(c, b) & 255)])), 4294967295::BIGINT)"


def manifest(source: str, levels: int = 7) -> str:
    """Merkle proofs of all rows: ``levels`` levels inside sources and two above them, so up to 16**levels rows a source and 256 sources."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def leaf(text: str) -> str:
        parts = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return "sha256(" + " || ".join(f"CASE WHEN {p} IS NULL THEN '-' ELSE strlen({p}) || ':' || {p} END" for p in parts) + ")"

    ctes = [f"""leaves AS (SELECT doc_id, source, {leaf('text')} AS leaf, CASE WHEN {_crc32('doc_id::VARCHAR')} % 5 = 0 THEN {leaf(f"translate(text, '{upper}', '{lower}')")} END AS other FROM {source})""",
            "a0 AS (SELECT doc_id, leaf, coalesce(other, leaf) AS f, '' AS proof, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM leaves)",
            "n0 AS (SELECT g, p, leaf AS h FROM a0)"]

    def step(k: int, nodes: str, into: str) -> None:
        ctes.append(f"r{k} AS (SELECT g, p // 16 AS p, string_agg(h, '' ORDER BY p) AS run, sum(count(*)) OVER (PARTITION BY g) AS n FROM {nodes} GROUP BY g, p // 16)")
        ctes.append(f"n{k} AS (SELECT g, p, CASE WHEN n = 1 THEN run ELSE sha256(run) END AS h FROM r{k})")
        left, right = "substr(run, 1, 64 * (a.p % 16)::INT)", "substr(run, 65 + 64 * (a.p % 16)::INT)"
        ctes.append(f"""{into}{k} AS (SELECT a.* EXCLUDE (p, f, proof), a.p // 16 AS p, CASE WHEN n = 1 THEN f ELSE sha256({left} || f || {right}) END AS f,
  CASE WHEN n = 1 THEN proof ELSE proof || {left} || {right} END AS proof FROM {into}{k - 1} a JOIN r{k} ON a.g = r{k}.g AND a.p // 16 = r{k}.p)""")

    for k in range(1, levels + 1):
        step(k, f"n{k - 1}", "a")
    ctes.append(f"a{levels + 1} AS (SELECT a.* EXCLUDE (g, p), 0 AS g, a.g AS p, h AS subroot FROM a{levels} a JOIN n{levels} ON a.g = n{levels}.g)")
    ctes.append(f"n{levels + 1} AS (SELECT 0 AS g, g AS p, h FROM n{levels})")
    for k in (levels + 2, levels + 3):
        step(k, f"n{k - 1}", "a")
    return f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified FROM a{levels + 3}, (SELECT h FROM n{levels + 3})"


def lexical(source: str, items: str, k: int = 10) -> str:
    """The best documents of every item, all pairs with a common term scored."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH wanted AS (SELECT row_number() OVER () AS i, item_id, unnest(list_distinct({words})) AS term FROM {items}),
docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM {source} WHERE text IS NOT NULL),
size AS (SELECT count(*) AS n_docs, sum(len(w)) AS n_all FROM docs WHERE len(w) > 0),
post AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs) SEMI JOIN wanted USING (term) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM post, size GROUP BY term),
length AS (SELECT r, doc_id, (100 - 90 + ((90 * len(w) * n_docs) // n_all))::BIGINT AS m FROM docs, size),
score AS (SELECT i, r, sum(weight.w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM wanted JOIN weight USING (term) JOIN post USING (term) JOIN length USING (r) GROUP BY i, r),
ranked AS (SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM score JOIN length USING (r) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked JOIN (SELECT DISTINCT i, item_id FROM wanted) USING (i) WHERE rank <= {k}"""
