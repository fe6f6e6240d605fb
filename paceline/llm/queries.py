"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paceline.llm.common import table


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paceline.llm.toxicity import CATEGORIES, fit, score

    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels"), CATEGORIES))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paceline.llm.secrets import digest

    return digest(table(spark, sf_dir, "documents"))


def op3_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paceline.llm.lattice_lm import likelihood

    return likelihood(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op4_anisotropic_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paceline.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op5_packed_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paceline.llm.bitpack import read_shards, write_shards

    return read_shards(write_shards(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paceline.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op7_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paceline.llm.mixing import mix, tempered

    docs = table(spark, sf_dir, "documents")
    return mix(docs, tempered(docs))


def op8_branch_and_bound_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paceline.llm.topk import exact_top_k

    return exact_top_k(table(spark, sf_dir, "embeddings"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paceline.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2, length=1024)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paceline.llm.suffix_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), length=400)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


#: Integer inner products over all pairs of a query and a candidate.
TOPK_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_branch_and_bound_topk": TOPK_SQL}
