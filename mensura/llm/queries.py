"""The operators' queries over the shared tables, one for each, and what SQL can say of them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mensura.llm import decontam, idfiles, infill, jaccard, licenses, lines, negatives, personal, pieces, quality, segments, suffix, tokencount, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(spark, table(spark, sf_dir, "documents"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(spark, table(spark, sf_dir, "documents"), keep=False).drop("kept")


def op3_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = segments.tokenizers_path("word_bpe_49k.json")
    return idfiles.id_files(spark, table(spark, sf_dir, "documents"), tokenizer, 49408)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = segments.tokenizers_path("byte_bpe_50k.json")
    return tokencount.token_counts(spark, table(spark, sf_dir, "documents"), tokenizer)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_join(spark, table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = segments.tokenizers_path("piece_bpe_32k.model")
    return pieces.round_trip(spark, table(spark, sf_dir, "documents"), model)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mined(spark, table(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.report(table(spark, sf_dir, "documents"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    own = [op1_quality_rules, op2_suffix_array_dedup, op3_token_id_files, op4_token_counts, op5_toxicity, op6_ngram_jaccard_join, op7_sentencepiece, op8_license_scan, op9_line_dedup, op10_decontamination, op11_hard_negatives, op12_fill_in_middle, op13_personal_data]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op9_line_dedup": lines.SQL, "op11_hard_negatives": negatives.SQL, "op12_fill_in_middle": infill.SQL}
