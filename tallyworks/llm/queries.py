"""The registered queries of this subpackage, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import (
    alignment,
    bpe,
    decontaminate,
    languages,
    licenses,
    merkle,
    nearest,
    pii,
    pst,
    simhash,
    spotsigs,
    suffixes,
    tokenfiles,
)
from tallyworks.llm.common import documents, table
from tallyworks.session import work_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(plan: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = plan
        if sql:
            ORACLE_SQL[name] = sql
        return plan

    return add


@query("op1_simhash")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(
        documents(spark, sf_dir, "doc_id", "text"), width=3, max_bits=2
    )
    return found.select(
        F.col("id").alias("doc_id"),
        simhash.hexadecimal("fingerprint").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query("op2_suffixes")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(documents(spark, sf_dir, "doc_id", "text"), length=200)
    removed = F.col("n_bytes") - F.octet_length("kept")
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        removed.cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op3_token_files")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "token-files")
    tokenfiles.write_tokens(documents(spark, sf_dir, "doc_id", "text"), path, WORD_BPE, 2)
    return tokenfiles.read_digests(spark, path).select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )


@query("op4_pii")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(documents(spark, sf_dir, "doc_id", "text"))
    base = F.filter("spans", lambda span: span["base"])

    def counted(kind: str) -> Column:
        return F.size(F.filter(base, lambda span: span["kind"] == kind)).cast("long")

    def printed(spans: Column | str) -> Column:
        one = lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"])
        return F.array_join(F.transform(spans, one), ",")

    return found.select(
        "doc_id",
        *(counted(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        F.sha2(printed(base), 256).alias("base_sha256"),
        printed("spans").alias("spans"),
    )


@query("op5_suffix_tree")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    held_out = pst.held_out(F.col("doc_id"))
    found = pst.score(docs, ~held_out)
    return found.select(
        F.col("id").alias("doc_id"),
        (~F.col("trains")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@query("op6_bpe")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.digests(documents(spark, sf_dir, "doc_id", "text"), WORD_BPE)
    return found.withColumnRenamed("id", "doc_id")


@query("op7_spotsigs")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spotsigs.edited_pairs(documents(spark, sf_dir, "doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        spotsigs.printed("own").alias("fingerprint"),
        spotsigs.printed("changed").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query("op8_decontaminate")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    docs = documents(spark, sf_dir, "doc_id", "text")
    found = decontaminate.contaminated(docs, benchmark)
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("item").alias("item_id"),
        "windows",
        "longest",
        "share",
        "changed",
    )


@query("op9_licenses")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf_dir, "doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        F.array_join("expressions", ";").alias("expressions"),
        F.array_join("choices", ";").alias("choices"),
        "score",
    )


@query("op10_language")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    found = languages.identify(docs.select("doc_id", "text"), languages.learn(docs))
    return found.select(
        "doc_id", languages.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


MERKLE_SQL = """
WITH RECURSIVE keyed AS (
  SELECT *, xor(list_reduce(
      list_prepend(4294967295::UBIGINT,
                   list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
      lambda c, b: list_reduce(
          list_prepend(xor(c, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
          lambda d, i: xor(d >> 1, 3988292384::UBIGINT * (d & 1)))),
      4294967295::UBIGINT) % 7 = 0 AS changes
  FROM documents
), parts AS (
  SELECT doc_id, lang, changes, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM keyed
), leaves AS (
  SELECT doc_id, lang, changes,
    sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) AS other
  FROM parts
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
), levels AS (
  SELECT lang, 0 AS level, pos, n, leaf AS node FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(node || coalesce(after, ''))
  FROM (SELECT *, lead(node) OVER (PARTITION BY lang ORDER BY pos) AS after FROM levels WHERE n > 1)
  WHERE pos % 2 = 0
), subroots AS (
  SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos,
    count(*) OVER () AS n
  FROM levels WHERE n = 1
), tops AS (
  SELECT 0 AS level, pos, n, subroot AS node FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(node || coalesce(after, ''))
  FROM (SELECT *, lead(node) OVER (ORDER BY pos) AS after FROM tops WHERE n > 1)
  WHERE pos % 2 = 0
), heights AS (
  SELECT lang, max(level) AS height FROM levels GROUP BY lang
), steps AS (
  SELECT p.doc_id, l.level, (p.pos >> l.level) % 2 = 1 AS before, s.node
  FROM placed p
  JOIN levels l ON l.lang IS NOT DISTINCT FROM p.lang AND l.n > 1 AND l.pos = p.pos >> l.level
  LEFT JOIN levels s
    ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = l.level AND s.pos = xor(l.pos, 1)
  UNION ALL
  SELECT p.doc_id, h.height + l.level, (r.pos >> l.level) % 2 = 1, s.node
  FROM placed p
  JOIN heights h ON h.lang IS NOT DISTINCT FROM p.lang
  JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
  JOIN tops l ON l.n > 1 AND l.pos = r.pos >> l.level
  LEFT JOIN tops s ON s.level = l.level AND s.pos = xor(l.pos, 1)
), folds AS (
  SELECT doc_id, 0 AS level, CASE WHEN changes THEN other ELSE leaf END AS node FROM placed
  UNION ALL
  SELECT f.doc_id, f.level + 1, sha256(CASE WHEN s.before THEN s.node || f.node
                                            ELSE f.node || coalesce(s.node, '') END)
  FROM folds f JOIN steps s ON s.doc_id = f.doc_id AND s.level = f.level
), proofs AS (
  SELECT doc_id, sha256(coalesce(string_agg(node, '' ORDER BY level), '')) AS proof_sha256
  FROM steps GROUP BY doc_id
), folded AS (
  SELECT doc_id, arg_max(node, level) AS folded_root FROM folds GROUP BY doc_id
)
SELECT p.doc_id, p.leaf, r.subroot, t.node AS root, coalesce(o.proof_sha256, sha256('')) AS proof_sha256,
  f.folded_root, f.folded_root = t.node AS verified
FROM placed p
JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
JOIN (SELECT node FROM tops WHERE n = 1) t ON true
LEFT JOIN proofs o ON o.doc_id = p.doc_id
JOIN folded f ON f.doc_id = p.doc_id
"""


@query("op13_merkle", MERKLE_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = documents(spark, sf_dir, *columns)
    manifest = merkle.build(
        docs,
        columns,
        id_col="doc_id",
        tree_col="lang",
        changed=F.crc32(F.col("doc_id").cast("string")) % 7 == 0,
        changes={"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1},
    )
    return manifest.proofs().select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


@query("op11_alignment")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    found, _ = alignment.align(docs, BYTE_BPE, PIECE_BPE)
    return found.withColumnsRenamed({"id": "doc_id", "groups": "groups_sha256"})


TOP_K_SQL = """
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_inner_product(q.vector, c.vector)::BIGINT AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY score DESC, c.vec_id) AS rank
  FROM scaled q JOIN scaled c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query("op12_top_k", TOP_K_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    found = nearest.top_k(rows, F.col("id") % 20 == 0, 20)
    return found.withColumnRenamed("id", "vec_id")
