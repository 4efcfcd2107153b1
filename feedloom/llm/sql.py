"""SQL that is written by rule."""

from __future__ import annotations

#: Levels of a tree that the SQL spells out: 8 ** 12 leaves a language.
HEIGHT = 12


def merkle(height: int = HEIGHT) -> str:
    """The rows of ``op13_merkle``: one pair of tables for each level, in the languages' trees and then in that of their roots."""
    value = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR END"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = " || ".join(value.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    bit = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    sql = f"""
        WITH crc0 AS (
            SELECT i, i AS c FROM range(256) t(i)
        ), {", ".join(f"crc{k + 1} AS (SELECT i, {bit} AS c FROM crc{k})" for k in range(8))}, crc_table AS (
            SELECT list(c ORDER BY i) AS crcs FROM crc8
        ), hashed AS (
            SELECT doc_id, lang,
                   sha256({parts} || {value.format("text")}) AS leaf,
                   sha256({parts} || {value.format("lowered")}) AS changed,
                   xor(list_reduce(
                       list_transform(range(length(doc_id::VARCHAR)), lambda k: ascii(substr(doc_id::VARCHAR, k + 1, 1))::BIGINT),
                       lambda a, b: xor(a // 256, crcs[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % 3 = 0 AS picked
            FROM (SELECT *, {lower} AS lowered FROM documents), crc_table
        ), l0 AS MATERIALIZED (
            SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                   count(*) OVER (PARTITION BY lang) AS size, leaf AS node, doc_id,
                   CASE WHEN picked THEN changed ELSE leaf END AS later
            FROM hashed
        )"""
    for side, key, first in (("l", "lang", None), ("t", "one", True)):
        if first:
            sql += f""", t0 AS MATERIALIZED (
                SELECT 1 AS one, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS size, node, lang
                FROM l{height}
            )"""
        for k in range(height):
            sql += f""", {side}{k + 1} AS MATERIALIZED (
                SELECT {key}, place // 8 AS place, (any_value(size) + 7) // 8 AS size,
                       CASE WHEN any_value(size) > 1 THEN sha256(string_agg(node, '' ORDER BY place)) ELSE any_value(node) END AS node
                FROM {side}{k} GROUP BY {key}, place // 8
            ), s{side}{k} AS MATERIALIZED (
                SELECT {key}, place, CASE WHEN size > 1 THEN
                       [coalesce(string_agg(node, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''),
                        coalesce(string_agg(node, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')] END AS both
                FROM {side}{k} WINDOW r AS (PARTITION BY {key}, place // 8 ORDER BY place)
            )"""
        keep = "lang" if first else "doc_id, later"
        sql += f""", {side}p0 AS (SELECT {key}, place, node, {keep}, place AS at, []::VARCHAR[][] AS proof FROM {side}0)"""
        for k in range(height):
            sql += f""", {side}p{k + 1} AS (
                SELECT p.{key}, p.place, p.node, {keep}, p.at // 8 AS at,
                       CASE WHEN s.both IS NULL THEN p.proof ELSE list_append(p.proof, s.both) END AS proof
                FROM {side}p{k} p JOIN s{side}{k} s ON p.{key} IS NOT DISTINCT FROM s.{key} AND p.at = s.place
            )"""
    return (
        sql
        + f""", whole AS (
            SELECT l.doc_id, l.node AS leaf, t.node AS subroot, (SELECT node FROM t{height}) AS root, l.later,
                   list_concat(l.proof, t.proof) AS proof
            FROM lp{height} l JOIN tp{height} t ON l.lang IS NOT DISTINCT FROM t.lang
        ), folded AS (
            SELECT *, list_reduce(list_transform(proof, lambda s: s), lambda a, s: ['', sha256(s[1] || a[2] || s[2])], ['', later])[2] AS folded_root
            FROM whole
        )
        SELECT doc_id, leaf, subroot, root,
               sha256(list_aggregate(list_append(list_transform(proof, lambda s: s[1] || s[2]), ''), 'string_agg', '')) AS proof_sha256,
               folded_root, folded_root = root AS verified
        FROM folded
    """
    )
