"""The registered queries: each operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotebook.llm.alignment import align
from quotebook.llm.catalog import ORACLES, query, table
from quotebook.llm.decontamination import contamination
from quotebook.llm.exact_dedup import find_copies
from quotebook.llm.html_text import extract_text
from quotebook.llm.merkle import folded, manifest, proof_hash
from quotebook.llm.near_duplicates import near_duplicates
from quotebook.llm.packing import pack
from quotebook.llm.quality import classify
from quotebook.llm.secrets import KINDS, find_secrets, written
from quotebook.llm.sharding import assign_shards
from quotebook.llm.token_counts import count_tokens
from quotebook.llm.toxicity import score_toxicity
from quotebook.llm.vector_packing import vector_pack


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The packing's rows with a checksum in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per document."""
    return count_tokens(table(spark, sf_dir, "documents"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence of 1024 ids."""
    return piece_digests(pack(table(spark, sf_dir, "documents")))


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 per document."""
    return find_copies(table(spark, sf_dir, "documents"))


ORACLES["op3_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per document, in 8 shards."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    )
    return assign_shards(docs, 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), "contaminated"
    )


ORACLES["op9_decontamination"] = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS i FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, array_to_string(w[i + 1 : i + 10], ' ') AS t, least(len(w), 10) AS k FROM starts),
ks AS (SELECT DISTINCT k FROM win),
places AS (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS i FROM dw, ks WHERE len(w) >= k),
hits AS (SELECT p.doc_id, p.i, p.k, win.item_id FROM places p
         JOIN win ON win.k = p.k AND win.t = array_to_string(p.w[p.i + 1 : p.i + p.k], ' ')),
hit_words AS (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM (SELECT DISTINCT doc_id, i, k FROM hits)),
n AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM hit_words GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
               array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM hits GROUP BY doc_id)
SELECT dw.doc_id, len(dw.w) AS n_words, coalesce(n.n_hit, 0) AS n_hit, coalesce(its.n_items, 0) AS n_items,
       sha256(coalesce(its.ids, '')) AS items_sha256, n.n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN n USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query
def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans per document."""
    found = find_secrets(table(spark, sf_dir, "documents"))

    # Bound here: a second parameter of the lambda would be the place in the array.
    def counted(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")

    counts = [counted(i).alias(f"n_{name}") for i, name in enumerate(KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted per document."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id, class_size, n_links, kept per document: five-word shingles, similarity 0.8 or more."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("h")


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lang, perplexity, threshold, kept per document; trusted are the documents labelled good."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars per page."""
    return extract_text(table(spark, sf_dir, "pages"))


def tampered(text: str = "text", id_col: str = "doc_id") -> Column:
    """The text without line ends where 2 divides the checksum of the id, else as it is."""
    struck = F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0
    return F.when(struck, F.translate(text, "\n", "")).otherwise(F.col(text))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified per document, some texts being tampered with."""
    proofs = manifest(table(spark, sf_dir, "documents"), presented={"text": tampered()})
    return proofs.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_hash().alias("proof_sha256"), folded().alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _hashed(*values: str) -> str:
    coded = [f"coalesce(strlen({v}::VARCHAR)::VARCHAR || ':' || {v}::VARCHAR, '-')" for v in values]
    return f"sha256({' || '.join(coded)})"


def _beside(level: str, group: str) -> str:
    """Digests left and right of each node in its run of three."""
    return f"""SELECT *, coalesce(lag(h, 2) OVER w, '') || coalesce(lag(h, 1) OVER w, '') AS l,
         coalesce(lead(h, 1) OVER w, '') || coalesce(lead(h, 2) OVER w, '') AS r
  FROM {level} WHERE n > 1 WINDOW w AS (PARTITION BY {group}lvl, i // 3 ORDER BY i)"""


# The checksum's bits are taken one by one: a byte is added, then shifted out eight times.
ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE base AS (
  SELECT *, CASE WHEN list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
      lambda ch: list_concat([ascii(ch)::BIGINT], list_transform(range(8), lambda k: (-1)::BIGINT))))),
      lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) ELSE xor(c >> 1, 3988292384 * (c & 1)) END) % 2 = 1
    THEN replace(text, chr(10), '') ELSE text END AS claimed FROM documents),
leaves AS (
  SELECT doc_id, source, {_hashed('doc_id', 'source', 'lang', 'n_chars', 'text')} AS leaf,
         {_hashed('doc_id', 'source', 'lang', 'n_chars', 'claimed')} AS shown FROM base),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY source) AS n FROM leaves),
low AS (
  SELECT source AS g, 0 AS lvl, i, n, leaf AS h FROM ranked
  UNION ALL SELECT g, lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY g, lvl, i // 3, n),
subs AS (
  SELECT g, lvl AS depth, h AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lvl, i, n, subroot AS h FROM subs
  UNION ALL SELECT lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY lvl, i // 3, n),
low_sib AS ({_beside('low', 'g, ')}),
high_sib AS ({_beside('high', '')}),
fold AS (
  SELECT source AS g, i AS leaf_i, 0 AS lvl, i, shown AS h, '' AS proof FROM ranked
  UNION ALL SELECT f.g, f.leaf_i, f.lvl + 1, f.i // 3, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
  FROM fold f JOIN low_sib s ON f.g IS NOT DISTINCT FROM s.g AND f.lvl = s.lvl AND f.i = s.i),
mid AS (
  SELECT f.g, f.leaf_i, s.subroot, s.i, f.h, f.proof FROM fold f JOIN subs s ON f.g IS NOT DISTINCT FROM s.g AND f.lvl = s.depth),
rise AS (
  SELECT g, leaf_i, subroot, 0 AS lvl, i, h, proof FROM mid
  UNION ALL SELECT f.g, f.leaf_i, f.subroot, f.lvl + 1, f.i // 3, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
  FROM rise f JOIN high_sib s ON f.lvl = s.lvl AND f.i = s.i),
top AS (SELECT lvl, h AS root FROM high WHERE n = 1)
SELECT k.doc_id, k.leaf, f.subroot, t.root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = t.root AS verified
FROM ranked k JOIN rise f ON k.source IS NOT DISTINCT FROM f.g AND k.i = f.leaf_i JOIN top t ON f.lvl = t.lvl
"""


@query
def op12_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence of at most 2048 ids."""
    pieces = vector_pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per document."""
    return align(table(spark, sf_dir, "documents"), with_groups=False).drop("groups")
