"""What the training-data operators register: one query each over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.llm import mixing, negatives, sharding, shingle_join, sketch, url_filter, warc
from tidemart.llm.common import table


def tokenizer_path(name: str) -> str:
    """A public vocabulary file; they are installed beside Python and never copied into the repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_bpe() -> tuple[str, str, str]:
    import public_tokenizers

    return tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.llm.shingle_join import similar_rows

    return similar_rows(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "links")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.llm.token_count import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.llm.warc import archive_index

    index = archive_index(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "rank")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.llm.url_filter import judge

    return judge(table(spark, sf_dir, "pages"))


def op7_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.llm.sketch import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.llm.toxicity import learn, scored

    docs = table(spark, sf_dir, "documents")
    return scored(docs, learn(docs, table(spark, sf_dir, "labels")))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), byte_bpe())


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.llm.media import media_features

    return media_features(table(spark, sf_dir, "documents"))


#: Target weights of the mixture: the large source twice the share of each other.
WEIGHTS = {"src0": 2}


def op9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.llm.mixing import schedule

    return schedule(table(spark, sf_dir, "documents"), weights=WEIGHTS)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.llm.quality import learn, scored

    docs = table(spark, sf_dir, "documents")
    return scored(docs, learn(docs, table(spark, sf_dir, "labels")))


#: Beside the equal shards: the shard if they weighed 1 to 8.
STEPPED = {"weighted_shard": [float(s + 1) for s in range(sharding.SHARDS)]}


def op11_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), others=STEPPED)


def op12_svd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemart.llm.whitening import whitened

    rows = whitened(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation as long)"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    shifted = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", shifted), vec_id % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_shingle_join": op1_shingle_join,
    "op2_token_counts": op2_token_counts,
    "op3_warc_index": op3_warc_index,
    "op4_url_filter": op4_url_filter,
    "op5_toxicity": op5_toxicity,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_scaled_sketch": op7_scaled_sketch,
    "op8_media_columns": op8_media_columns,
    "op9_mixture": op9_mixture,
    "op10_quality": op10_quality,
    "op11_rendezvous_shards": op11_rendezvous_shards,
    "op12_svd_whitening": op12_svd_whitening,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op1_shingle_join": shingle_join.SQL,
    "op3_warc_index": warc.SQL,
    "op4_url_filter": url_filter.sql(),
    "op7_scaled_sketch": sketch.SQL,
    "op9_mixture": mixing.sql(WEIGHTS),
    "op11_rendezvous_shards": sharding.sql(STEPPED),
    "op13_hard_negatives": negatives.SQL,
}
