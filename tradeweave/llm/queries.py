"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op6_warc_revisits", oracle=r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
hashed AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
named AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS largest FROM hashed)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN largest END AS refers_to
FROM named""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    from tradeweave.llm.warc import archive_and_read
    rows = archive_and_read(table(spark, folder, "pages"))
    return rows.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                       "record_type", F.col("refers_to").cast("long").alias("refers_to"))


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op7_line_rules")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    from tradeweave.llm.line_rules import judge_documents
    docs = table(spark, folder, "documents")
    return judge_documents(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                        "n_repeat_words", "base_failed", "kept", "lost_words")


@query("op9_hypergeometric_shards")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    from tradeweave.llm.sharding import shuffle_into_shards
    rows = shuffle_into_shards(table(spark, folder, "documents"), n_shards=40)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return rows.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


@query("op1_entropy_mix")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    from tradeweave.llm.mixing import mix
    return mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "rate", "copies")


@query("op10_pivot_top_k", oracle="""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 5""")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    from tradeweave.llm.topk import top_k
    return top_k(table(spark, folder, "embeddings"))


PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op5_language_id")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    from tradeweave.llm.language import identify
    left_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    told = identify(table(spark, folder, "documents"), tokenizer_path(PIECES), learn_from=~left_out)
    return told.select("doc_id", F.coalesce(left_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op4_quality_nbsvm")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    from tradeweave.llm.quality_model import classify
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    scored = classify(table(spark, folder, "documents"), table(spark, folder, "labels"), learn_from=~held_out)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op3_lm_cross_entropy")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    from tradeweave.llm.ngram_counts import score_by_counts
    return score_by_counts(table(spark, folder, "documents"), table(spark, folder, "labels")).select(
        "doc_id", "n_tokens", "target_loss", "background_loss", "score")


BYTE_BPE = "byte_bpe_50k.tiktoken"  # the vocabulary of byte_bpe_50k.json as ranks; a test holds the ids against it


@query("op8_best_fit_packing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    from tradeweave.llm.packing import pack
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pack(docs, tokenizer_path(BYTE_BPE)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op2_jaccard_join")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    from tradeweave.llm.ngram_join import jaccard_components
    return jaccard_components(table(spark, folder, "documents"))


@query("op11_whole_token_counts")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    from tradeweave.llm.token_counts import count_tokens
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return count_tokens(docs, tokenizer_path("word_bpe_49k.json"), limit=2048).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op12_importance_resampling")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    from tradeweave.llm.resampling import resample
    docs = table(spark, folder, "documents").select("doc_id", "text")
    drawn = resample(docs, table(spark, folder, "benchmark"), percent=5, least_words=20, seed=42, carry=["doc_id"])
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_collocations", oracle=r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                         'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents),
p AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
g AS (SELECT lang, id, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i FROM p),
runs AS (SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4 FROM g
         WINDOW o AS (PARTITION BY id ORDER BY i)),
f AS (SELECT lang, w1 AS phrase, 1 AS size, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= 30
      UNION ALL SELECT lang, w1 || ' ' || w2, 2, count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
      UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3, count(*) FROM runs WHERE w3 IS NOT NULL
      GROUP BY ALL HAVING count(*) >= 30
      UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4, count(*) FROM runs WHERE w4 IS NOT NULL
      GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size >= 2),
cuts AS (SELECT c.lang, c.phrase, c.a, cut, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a) // (x.a + y.a) AS score
         FROM c, (VALUES (1), (2), (3)) k(cut), f x, f y
         WHERE cut < c.size AND x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
           AND y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:c.size], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_runs AS (SELECT c.lang, array_to_string(c.w[i:i + size2 - 1], ' ') AS phrase, max(c.a) AS longer
               FROM c, (VALUES (1), (2), (3)) s(i), (VALUES (2), (3)) t(size2)
               WHERE size2 < c.size AND i + size2 - 1 <= c.size GROUP BY ALL),
kept AS (SELECT weakest.* FROM weakest LEFT JOIN inner_runs USING (lang, phrase)
         WHERE longer IS NULL OR 100 * longer < 80 * a),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM placed JOIN total USING (lang) WHERE rank <= 2000""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    from tradeweave.llm.collocations import collocations
    return collocations(table(spark, folder, "documents"), least=30, most=2000).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
