"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_minhash_dedup(spark, sf_dir):
    from dockyard.llm.minhash import near_groups
    return near_groups(_table(spark, sf_dir, "documents"), words=2, percent=80)


def op4_exact_dedup(spark, sf_dir):
    from dockyard.llm.exact_dedup import exact_groups
    return exact_groups(_table(spark, sf_dir, "documents"), keep="max")


def op5_chat_format(spark, sf_dir):
    from dockyard.llm.chat import format_turns, read_back
    own = "</s>[INST] ok [/INST]"
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], turns.schema)
    return read_back(format_turns(turns.unionByName(extra)))


def op6_line_dedup(spark, sf_dir):
    from dockyard.llm.lines import drop_lines
    return drop_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op7_suffix_dedup(spark, sf_dir):
    from dockyard.llm.repeats import remove_repeats
    cut = remove_repeats(_table(spark, sf_dir, "documents"), length=50)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_top_k(spark, sf_dir):
    from dockyard.llm.topk import top_k
    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5, scale=256)


def op1_best_fit_packing(spark, sf_dir):
    import public_tokenizers
    from dockyard.llm.packing import pack_documents
    packed = pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2048, 0)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op2_html_extract(spark, sf_dir):
    from dockyard.llm.html_text import extract
    return extract(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op9_language_id(spark, sf_dir):
    from dockyard.llm.langid import fit, held_out, identify
    docs = _table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()))
    return (identify(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected"))


def op10_byte_bpe(spark, sf_dir):
    import public_tokenizers
    from dockyard.llm.bpe import decode, encode
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return decode(encode(_table(spark, sf_dir, "documents"), path), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_sharding(spark, sf_dir):
    from dockyard.llm.sharding import shard
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    raw = F.coalesce("text", F.lit("")).cast("binary")
    return shard(docs, shards=8, seed=11).select(
        "doc_id", (F.length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_hard_negatives(spark, sf_dir):
    from dockyard.llm.negatives import mine
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return mine(vectors, vectors.filter("vec_id % 100 = 0"), positives=5, negatives=10, low=30, high=90, scale=256)


def op13_whitening(spark, sf_dir):
    from dockyard.llm.whitening import whiten
    exact = whiten(_table(spark, sf_dir, "embeddings"), components=8, scale=1024, shift=100000)
    return exact.withColumn("deviation_exact", F.col("deviation")).withColumn(
        "deviation", F.expr("try_cast(deviation AS long)"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_best_fit_packing, op2_html_extract, op3_minhash_dedup, op4_exact_dedup, op5_chat_format, op6_line_dedup, op7_suffix_dedup, op8_top_k,
                            op9_language_id, op10_byte_bpe, op11_sharding, op12_hard_negatives, op13_whitening)
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op4_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, {_LOWER} AS t FROM documents)
        WINDOW g AS (PARTITION BY t)""",
    "op8_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
        r AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
            FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op12_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                   CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
               s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
             AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
        QUALIFY rank <= 10""",
}
