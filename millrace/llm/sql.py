"""SQL that DuckDB answers like the operators that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DIVERGENCE = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
    FROM documents),
words AS (SELECT id, lang, source, unnest(found) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, v,
           (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) + v))::HUGEINT AS p,
           sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, k.term) AS lang_n,
           sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang) AS lang_total
    FROM groups g JOIN kept k USING (lang) JOIN sizes USING (lang) LEFT JOIN counts c USING (lang, source, term)),
marked AS (
    SELECT *, (1 + (1000000000::HUGEINT * (lang_n + 1)) // (lang_total + v))::HUGEINT AS q FROM shares WHERE n > 0),
apart AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM marked WHERE p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
WHERE part = 'pair' OR rank <= 200
"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


#: crc32 by its reflected polynomial, a byte at a time.
_CRC = """(4294967295 - list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda acc, byte: xor(acc >> 8, list_extract(crc_table, (xor(acc, byte) & 255) + 1))))"""
_CRC_TABLE = """(SELECT list(list_reduce(list_prepend(i::BIGINT, [0,0,0,0,0,0,0,0]::BIGINT[]),
    lambda acc, x: CASE WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384::BIGINT) ELSE acc >> 1 END) ORDER BY i) FROM range(256) t(i))"""


def _tree(name: str, nodes: str, levels: int) -> str:
    """Levels ``name0`` and up of ``key, place, n, digest``: each node with its siblings and the digest of its run."""
    parts = []
    for k in range(levels):
        below = nodes if k == 0 else f"{name}{k - 1}_up"
        run = "PARTITION BY key, place // 16 ORDER BY place"
        parts.append(f"""{name}{k} AS (
            SELECT key, place, n, digest,
                   coalesce(string_agg(digest, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(digest, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM {below})""")
        parts.append(f"""{name}{k}_up AS (
            SELECT key, place // 16 AS place, any_value((n + 15) // 16) AS n,
                   CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY place)) ELSE any_value(digest) END AS digest
            FROM {name}{k} GROUP BY key, place // 16)""")
    return ",\n".join(parts)


_LEVELS = 6  # 16 million documents a source, 16 million sources


def _merkle() -> str:
    joins, proof, folded = [], [], "coalesce(tampered, leaf)"
    for tree, key, place in (("n", "d.key", "d.place"), ("s", "''", "o.place")):
        for k in range(_LEVELS):
            a = f"{tree}{k}"
            joins.append(f"JOIN {a} ON {a}.key = {key} AND {a}.place = {place} // {16**k}")
            proof.append(f"CASE WHEN {a}.n > 1 THEN {a}.l || {a}.r ELSE '' END")
    sql = f"""
WITH t AS MATERIALIZED (SELECT {_CRC_TABLE} AS crc_table),
docs AS (
    SELECT coalesce('1' || source, '0') AS key, doc_id, {_leaf("text")} AS leaf,
           CASE WHEN doc_id IS NOT NULL AND {_CRC} % 5 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS tampered
    FROM documents, t),
d AS MATERIALIZED (
    SELECT *, leaf AS digest, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY key) AS n FROM docs),
{_tree("n", "d", _LEVELS)},
sources AS (SELECT '' AS key, key AS of, row_number() OVER (ORDER BY key) - 1 AS place, count(*) OVER () AS n, digest FROM n{_LEVELS - 1}_up),
{_tree("s", "sources", _LEVELS)},
f0 AS (
    SELECT doc_id, leaf, o.digest AS subroot, (SELECT digest FROM s{_LEVELS - 1}_up) AS root, {folded} AS folded,
           sha256({" || ".join(proof)}) AS proof_sha256,
           {", ".join(f"{t}{k}.n AS {t}{k}n, {t}{k}.l AS {t}{k}l, {t}{k}.r AS {t}{k}r" for t in "ns" for k in range(_LEVELS))}
    FROM d JOIN sources o ON o.of = d.key {" ".join(joins)})"""
    for i, (t, k) in enumerate((t, k) for t in "ns" for k in range(_LEVELS)):
        a = f"{t}{k}"
        sql += f",\nf{i + 1} AS (SELECT * REPLACE (CASE WHEN {a}n > 1 THEN sha256({a}l || folded || {a}r) ELSE folded END AS folded) FROM f{i})"
    return sql + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, folded AS folded_root, folded = root AS verified FROM f{2 * _LEVELS}"


MERKLE = _merkle()
