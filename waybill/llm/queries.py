"""The registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from waybill.llm import decontamination, jaccard, neighbours, packing, periodic, pieces, preference, quality, ranking, rendering, toxicity, urls, warc
from waybill.llm.labelled import fold


MODEL = "piece_bpe_32k.model"
TOKENIZER = "word_bpe_49k.json"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _decided(scored: DataFrame, held_out: Column, limit: float) -> DataFrame:
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= limit).cast("int").alias("predicted"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations")
    pairs = preference.formatted(
        preference.pairs_by_opening(turns).withColumn("kind", F.lit("opening")).unionByName(
            preference.pairs_by_answer(turns).withColumn("kind", F.lit("answer"))))

    def ranges(mask: str) -> Column:
        return F.array_join(F.transform(mask, lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",")

    return pairs.select("kind", "chosen_id", "rejected_id", "prompt_turns", "prompt", "chosen_text", "rejected_text",
                        ranges("chosen_mask").alias("chosen_mask"), ranges("rejected_mask").alias("rejected_mask"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    space = quality.quality_model(docs, _read(spark, sf_dir, "labels"), ~held_out)
    return _decided(quality.scored(docs, space), held_out, 0.3)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_groups(_read(spark, sf_dir, "documents"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_read(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(_read(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))


def token_digests(docs: DataFrame, model: str) -> DataFrame:
    both = pieces.encoded(docs.select("doc_id", "text"), pieces.load(model))
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 3) == 1
    lexicon = toxicity.toxicity_model(docs, _read(spark, sf_dir, "labels"), ~held_out)
    return _decided(toxicity.scored(docs, lexicon), held_out, 0.7)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


URL_RULES = [
    urls.Rule(urls.BLOCK, "net", "/"), urls.Rule(urls.ALLOW, "example.net", "/en/"),
    urls.Rule(urls.BLOCK, "example.com", "/de/"), urls.Rule(urls.ALLOW, "org", "/fr/"),
]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(_read(spark, sf_dir, "pages"), URL_RULES).drop("block_score")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = rendering.rendered(_read(spark, sf_dir, "pages").select("page_id", "html"))
    return shown.select("page_id", "text", "n_blocks", F.length("text").cast("long").alias("n_chars"))


def _with_repeated_ends(docs: DataFrame) -> DataFrame:
    """Every document whose id has a crc32 divisible by 10 repeats what follows some word of it."""
    marked = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary"))).withColumn("g", F.expr("h DIV 10"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = marked.withColumn("words", F.when(F.col("h") % 10 == 0, split)).withColumn("n", F.size("words").cast("long"))
    placed = cut.withColumn("a", F.expr("g % greatest(n, 1)")).withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    repeated = F.expr("array_join(transform(sequence(0L, n - 1), i -> words[CAST(CASE WHEN i < a THEN i ELSE a + (i - a) % p END AS INT)]), ' ')")
    return placed.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.with_runs(_with_repeated_ends(_read(spark, sf_dir, "documents").select("doc_id", "text")))
    better = lambda a, b: a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"])
    best = F.aggregate("runs", F.lit(None).cast(periodic.RUN), lambda a, b: F.when(better(a, b), b).otherwise(a))
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(_read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_preference": op2_preference,
    "op3_quality": op3_quality,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_neighbours": op5_neighbours,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_url_filter": op9_url_filter,
    "op10_html_text": op10_html_text,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_packing": op12_packing,
    "op13_ranked_search": op13_ranked_search,
}
