"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwise.llm import alignment, ann, decontam, langid, lattice, neardup, packing, pii, quality, suffix, toxicity, warc, whitening
from bandwise.llm.common import fresh_dir, table, written


def tokenizer_path() -> str:
    """The public byte-level BPE file that the packing query is defined by."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_classifier_chain_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_chain(docs, toxicity_chain(docs, table(spark, sf_dir, "labels")))


def toxicity_chain(docs: DataFrame, labels: DataFrame):
    rows = toxicity.weak_categories(docs, labels)
    return toxicity.fit_chain(rows, ["insult", "contempt", "toxic"])


def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), encode_special_tokens=False)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "sequence_length")


def op3_bottom_k_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


#: Key of the registered queries; a run over real texts brings its own.
SURROGATE_KEY = "bandwise surrogates"


def op4_surrogate_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op7_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def _remainder(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op5_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = written(quality.document_statistics(table(spark, sf_dir, "documents")), "quality-stats")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit_quality(stats, labels.where(_remainder(5) != 0), calibrate=_remainder(5) == 1)
    return quality.score_quality(stats, model).select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_word_first_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit_languages(docs.where(_remainder(4) != 2))
    return langid.identify(docs, model).select(
        "doc_id", (_remainder(4) == 2).alias("held_out"), "lang_pred", "score")


def op8_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    warc.write_warc(warc.page_records(table(spark, sf_dir, "pages"), lambda df: written(df, "warc-first")), path)
    found = warc.read_warc(spark, path, verify="true").where(F.col("record_type").isin("response", "revisit"))
    page = lambda c: F.nullif(F.regexp_extract(c, r"^<urn:page:(-?\d*)>$", 1), F.lit("")).cast("long")
    return found.select(page("record_id").alias("page_id"),
                        F.coalesce(F.length("payload").cast("long"), F.col("payload_bytes")).alias("payload_bytes"),
                        "payload_digest", "record_type", page("refers_to").alias("refers_to"))


def pieces_path() -> str:
    """The public sentencepiece model that the alignment and lattice queries are defined by."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_inverted_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(), pieces_path())


def op12_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lattice.score_texts(table(spark, sf_dir, "documents"), pieces_path(), _remainder(5) != 1)
    return scored.select("doc_id", (_remainder(5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op13_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def llm_queries() -> dict:
    return {
        "op1_classifier_chain_toxicity": op1_classifier_chain_toxicity,
        "op2_harmonic_packing": op2_harmonic_packing,
        "op3_bottom_k_minhash": op3_bottom_k_minhash,
        "op4_surrogate_pii": op4_surrogate_pii,
        "op5_fourier_quality": op5_fourier_quality,
        "op6_word_first_language": op6_word_first_language,
        "op7_template_decontamination": op7_template_decontamination,
        "op8_learned_partitions": op8_learned_partitions,
        "op9_suffix_array_dedup": op9_suffix_array_dedup,
        "op10_warc_archives": op10_warc_archives,
        "op11_inverted_pair_bitmaps": op11_inverted_pair_bitmaps,
        "op12_subword_lattice": op12_subword_lattice,
        "op13_feast_whitening": op13_feast_whitening,
    }


def llm_oracles() -> dict:
    return {}
