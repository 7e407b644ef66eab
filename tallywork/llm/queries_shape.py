"""Queries that give texts and conversations another form: cuts, tries and trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm import merkle, middle, trie
from tallywork.llm.registry import query, table
from tallywork.llm.scratch import Scratch

MIDDLE_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), r AS (
  SELECT doc_id, text, n, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS one, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS other,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), c AS (SELECT *, least(one, other) AS a, greatest(one, other) AS b FROM r
), p AS (
  SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


@query("op11_fill_in_middle", MIDDLE_SQL)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two code points, with digests of the output and of the text rebuilt from it."""
    found = middle.transformed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    chars = {f"{part}_chars": F.char_length(part).cast("long") for part in ("prefix", "middle")}
    return found.select(
        "doc_id", "n", "form", *[value.alias(name) for name, value in chars.items()],
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(middle.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


TRIE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, list({'digest': digest, 'words': words} ORDER BY turn NULLS FIRST, digest, words) AS items
  FROM t GROUP BY conv_id
), forks AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
      lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT))),
    lambda acc, x: list_reduce(list_prepend(xor(acc, x), range(8)),
      lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)), 4294967295) % 4 AS h FROM own
), whole AS (
  SELECT f.conv_id, list_concat(coalesce(b.items[1:f.h], []), f.items[f.h + 1:]) AS items
  FROM forks f LEFT JOIN own b ON b.conv_id = f.conv_id - f.conv_id % 20
), steps AS (
  SELECT conv_id, len(items) AS size, items, unnest(range(0, len(items) + 1)) AS depth FROM whole
), member AS (
  SELECT conv_id, size, depth, array_to_string(list_transform(items[1:depth], lambda x: x.digest), '') AS path,
    CASE WHEN depth = 0 THEN 0 ELSE items[depth].words END AS words FROM steps
), node AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM member GROUP BY depth, path
), kids AS (
  SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1
), own_node AS (
  SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (path)
), up AS (
  SELECT left(path, CAST(32 * d AS BIGINT)) AS path, n_children, n_convs, words
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM own_node)
), subtree AS (
  SELECT path, sum(CAST(n_children = 0 AS BIGINT)) AS leaves, sum((n_convs - 1) * words) AS saved FROM up GROUP BY path
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(n.n_children AS BIGINT) AS n_children,
  CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM own_node n JOIN subtree s USING (path)
  LEFT JOIN own_node p ON n.depth > 0 AND p.path = left(n.path, CAST(32 * (n.depth - 1) AS BIGINT))
"""


@query("op12_conversation_prefix_trie", TRIE_SQL)
def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct sequence of first turns of the rebuilt conversations, with the figures of its subtree."""
    return trie.nodes(trie.rebuilt(table(spark, sf_dir, "conversations")), Scratch(spark))


_PIECES_SQL = merkle.PIECES.replace("}+[", "}[")
MERKLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    coalesce(lead(doc_id) OVER (ORDER BY doc_id DESC), max(doc_id) OVER ()) AS next_id FROM documents
), e AS (
  SELECT d.doc_id, d.next_id, d.text, CAST(d.n AS BIGINT) AS n_chars,
    substr(d.text, 1, d.n - d.n // 2) || substr(x.text, 1, d.n // 2) AS edited
  FROM d JOIN d AS x ON x.doc_id = d.next_id
), t AS (
  SELECT doc_id, 0 AS kind, text FROM e UNION ALL SELECT doc_id, 1, edited FROM e
), parts AS (
  SELECT doc_id, kind, list_transform(string_split(text, chr(10) || chr(10)), lambda s:
    list_transform(string_split(s, chr(10)), lambda p: regexp_extract_all(p, '{_PIECES_SQL}'))) AS parts FROM t
), tree AS (
  SELECT doc_id, kind,
    sha256('R' || array_to_string(list_transform(parts, lambda s: sha256('S' || array_to_string(list_transform(s, lambda p:
      sha256('P' || array_to_string(list_transform(p, lambda w: sha256('W' || w)), ''))), ''))), '')) AS root,
    list_distinct(list_transform(flatten(flatten(parts)), lambda w: sha256('W' || w) || ':' || length(w))) AS pieces
  FROM parts
), w AS (
  SELECT *, coalesce(list_sum(list_transform(pieces, lambda k: CAST(substr(k, 66) AS BIGINT))), 0) AS weight FROM tree
), near AS (
  SELECT e.doc_id, e.n_chars, sha256(e.edited) AS edited_sha256, a.root AS fingerprint, b.root AS edited_fingerprint,
    a.weight AS aw, b.weight AS bw, c.weight AS cw,
    coalesce(list_sum(list_transform(list_intersect(a.pieces, b.pieces), lambda k: CAST(substr(k, 66) AS BIGINT))), 0) AS ab,
    coalesce(list_sum(list_transform(list_intersect(a.pieces, c.pieces), lambda k: CAST(substr(k, 66) AS BIGINT))), 0) AS ac
  FROM e JOIN w a ON a.doc_id = e.doc_id AND a.kind = 0 JOIN w b ON b.doc_id = e.doc_id AND b.kind = 1
    JOIN w c ON c.doc_id = e.next_id AND c.kind = 0
)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  CASE WHEN aw + bw = 0 THEN 1.0::DOUBLE ELSE CAST(2 * ab AS DOUBLE) / (aw + bw) END AS near_edited,
  CASE WHEN aw + cw = 0 THEN 1.0::DOUBLE ELSE CAST(2 * ac AS DOUBLE) / (aw + cw) END AS near_next
FROM near
"""


@query("op13_document_fingerprints", MERKLE_SQL)
def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the root of its tree and of its edited text, and how alike the trees are."""
    return merkle.edited_pairs(table(spark, sf_dir, "documents")).drop("edits")
