"""Registered queries of the operators and their SQL; each is a thin digest of an operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith import session
from barsmith.llm import (
    content_sort, decontaminate, dense_search, fuzzy_hash, interpolated_lm, langid, licenses, merkle, minhash, pii,
    sentencepiece_codec, shards, warc,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def piece_model() -> str:
    """The public tokenizer file; its package is installed wherever tasks run."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded text of every document."""
    return sentencepiece_codec.tokens(_table(spark, folder, "documents"), piece_model(), keep_ids=False)


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document, of its edited text, and their likeness."""
    return fuzzy_hash.compare_with_next(_table(spark, folder, "documents"))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    docs = _table(spark, folder, "documents")
    return pii.find(docs, pii.fit(docs))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of documents and benchmark items that overlap."""
    return decontaminate.overlaps(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    """A record per page, written to archives and read back through the index."""
    index = warc.write(_table(spark, folder, "pages"), warc.archive_folder(spark))
    return warc.read(index, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document."""
    docs = _table(spark, folder, "documents")
    model = langid.fit(docs.where(~langid.held_out("doc_id")), "doc_id", "text", "lang")
    return langid.predict(docs, model).select(
        "doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Log probability of every document."""
    return interpolated_lm.score(_table(spark, folder, "documents"))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document, read back from the written shards."""
    stored = shards.write(_table(spark, folder, "documents"), session.scratch(spark, "shards"), 40, seed=7)
    text = F.coalesce("text", F.lit(""))
    return stored.select(
        "doc_id", (F.octet_length(text) + shards.ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate group of every document."""
    return minhash.groups(_table(spark, folder, "documents"))


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License labels of every document."""
    return licenses.scan(_table(spark, folder, "documents"))


def op11_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return dense_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The copies of every document and the one that stays."""
    return content_sort.groups(_table(spark, folder, "documents"), keep="largest")


LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Witness of every document, checked against the root after some texts were tampered with."""
    docs = _table(spark, folder, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    lost_breaks = merkle.leaf_hash(
        [F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in LEAF_COLUMNS])
    tampered = F.when(even & F.contains("text", F.lit("\n")), lost_breaks)
    shown = merkle.manifest(docs, LEAF_COLUMNS, keep={"tampered": tampered})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("steps"))
    return shown.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("steps")).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_fingerprints": op2_fingerprints,
    "op3_pii": op3_pii,
    "op4_decontamination": op4_decontamination,
    "op5_warc": op5_warc,
    "op6_language_id": op6_language_id,
    "op7_language_model": op7_language_model,
    "op8_sharding": op8_sharding,
    "op9_minhash": op9_minhash,
    "op10_licenses": op10_licenses,
    "op11_search": op11_search,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_merkle": op13_merkle,
}

_NORMALISED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_NORMALISED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_SEARCH = f"""
WITH docs AS MATERIALIZED (SELECT doc_id, {_TERMS} AS terms FROM documents),
corpus AS (SELECT count(*) FILTER (len(terms) > 0) AS n, sum(len(terms))::BIGINT AS l FROM docs),
counted AS (SELECT doc_id, len(terms) AS n, term, count(*) AS tf
  FROM (SELECT doc_id, terms, unnest(terms) AS term FROM docs) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM counted GROUP BY term),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (SELECT item_id, doc_id,
    sum(floor(1000 * ln((2 * corpus.n + 2) / (2 * df + 1)))::BIGINT
      * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * counted.n * corpus.n) // corpus.l))))::BIGINT AS score
  FROM wanted JOIN counted USING (term) JOIN df USING (term), corpus GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""

_COPIES = f"""
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_NORMALISED} AS t FROM documents) WINDOW w AS (PARTITION BY t ORDER BY doc_id DESC NULLS LAST)"""


def _leaf(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in values) + ")"


def _tree(name: str, leaves: str) -> str:
    """Nodes of every level of a group's tree, and for those below the top their siblings left and right."""
    run = "PARTITION BY g, lvl, pos // 3 ORDER BY pos ROWS BETWEEN"
    return f"""
{name}(g, lvl, pos, h) AS ({leaves} UNION ALL
  SELECT g, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM {name}) WHERE c > 1 GROUP BY g, lvl, pos // 3),
{name}_steps AS (SELECT g, lvl, pos,
    coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM (SELECT *, max(lvl) OVER (PARTITION BY g) AS top FROM {name}) WHERE lvl < top),
{name}_roots AS (SELECT g, arg_max(h, lvl) AS root FROM {name} GROUP BY g)"""


def _walk(name: str, tree: str, start: str) -> str:
    return f"""
{name}(id, g, lvl, pos, h, proof) AS ({start} UNION ALL
  SELECT id, g, lvl + 1, pos // 3, sha256(l || h || r), proof || l || r
  FROM {name} JOIN {tree}_steps USING (g, lvl, pos)),
{name}_end AS (SELECT id, g, arg_max(h, lvl) AS h, arg_max(proof, lvl) AS proof FROM {name} GROUP BY id, g)"""


#: The parity of the CRC-32 of an id's digits.
_EVEN = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''),
  lambda d: ascii(d)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k:
  CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) & 1 = 1"""

_MERKLE = f"""
WITH RECURSIVE leaves AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY g, pos) AS id FROM (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM (
    SELECT doc_id, coalesce('=' || source, '') AS g, {_leaf('text')} AS leaf,
      CASE WHEN {_EVEN} THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS tampered FROM documents))),
{_tree("tree", "SELECT g, 0, pos, leaf FROM leaves")},
{_tree("top", "SELECT 'all', 0, row_number() OVER (ORDER BY g) - 1, root FROM tree_roots")},
{_walk("up", "tree", "SELECT id, g, 0, pos, tampered, '' FROM leaves")},
places AS (SELECT g, row_number() OVER (ORDER BY g) - 1 AS place FROM tree_roots),
{_walk("over_", "top", "SELECT id, 'all', 0, place, h, proof FROM up_end JOIN places USING (g)")}
SELECT doc_id, leaf, tree_roots.root AS subroot, top_roots.root AS root, sha256(e.proof) AS proof_sha256,
  e.h AS folded_root, e.h = top_roots.root AS verified
FROM leaves JOIN over__end e USING (id) JOIN tree_roots ON tree_roots.g = leaves.g, top_roots"""

ORACLE: dict[str, str] = {"op11_search": _SEARCH, "op12_exact_dedup": _COPIES, "op13_merkle": _MERKLE}
