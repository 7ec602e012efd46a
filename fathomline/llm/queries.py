"""One query per operator, with production parameters over its whole table, and its answer in SQL where SQL can give it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, codes, embeddings, exact, html, jaccard, lexical, mixing, packing, recurrent, substring, toxicity, warc
from .common import table

_WS = r"[\x20\x09-\x0D]"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP1 = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
win AS (
  SELECT doc_id, i AS start, hash(array_to_string(words[i:i + 19], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w)),
later AS (
  SELECT doc_id, start FROM (SELECT doc_id, start, row_number() OVER (PARTITION BY h ORDER BY doc_id, start) AS nth FROM win) WHERE nth > 1),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(start, start + 20)))) AS pos FROM later GROUP BY 1),
kept AS (
  SELECT w.doc_id, len(words) AS n_words, coalesce(len(pos), 0) AS n_removed,
         CASE WHEN pos IS NULL THEN words ELSE list_select(words, list_filter(range(1, len(words) + 1), lambda i: NOT list_contains(pos, i))) END AS k
  FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept"""


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch, snapshot = exact.split_snapshot(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = exact.deduplicate(batch, snapshot)
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                        F.col("digest").alias("text_sha256"))


OP2 = f"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_WS}+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)"""


def op3_warc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.page_records(table(spark, sf_dir, "pages"))
    return read.select(F.col("id").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                       "record_type", "refers_to")


OP3 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to FROM p LEFT JOIN g USING (payload_digest)"""


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP6 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT doc_id, hash(array_to_string(words[i:i + 2], ' ')) AS h FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM w WHERE len(words) > 0) GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
pairs AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach(id, low) AS (SELECT doc_id, doc_id FROM documents UNION SELECT p.b, r.low FROM reach r JOIN pairs p ON p.a = r.id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, low AS component_id FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT id, min(low) AS low FROM reach GROUP BY 1) m ON m.id = d.doc_id"""


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
                                "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.render(chat.fold_events(chat.as_events(given.unionByName(own)))))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


OP8 = """
WITH RECURSIVE raw AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings),
v AS (
  SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS len FROM raw
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / a.len / b.len >= 0.9),
reach(id, low) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT p.b, r.low FROM reach r JOIN pairs p ON p.a = r.id)
SELECT e.vec_id, coalesce(n, 0) AS n_links, low AS component_id, e.vec_id = low AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM pairs GROUP BY 1) c ON c.a = e.vec_id
JOIN (SELECT id, min(low) AS low FROM reach GROUP BY 1) m ON m.id = e.vec_id"""


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.with_crc(packing.pack_documents(table(spark, sf_dir, "documents"), path))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.take(table(spark, sf_dir, "documents"), quality_weights(table(spark, sf_dir, "labels"))).select(
        "doc_id", "size", "source_size", "target", "taken")


def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent.scores(table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP12 = f"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS terms FROM documents),
size AS (SELECT k, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS l FROM size),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark),
tf AS (
  SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1), total),
part AS (
  SELECT k, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // l))) AS part
  FROM tf JOIN size USING (k) JOIN w USING (term), total),
scores AS (SELECT item_id, doc_id, k, CAST(sum(part) AS BIGINT) AS score FROM q JOIN part USING (term) GROUP BY ALL),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10"""


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"))
    return codes.label_errors(coded).select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256"))


def _op13_sql(rounds: int = 6) -> str:
    def nearest(n: int) -> str:
        return f"""far{n} AS MATERIALIZED (
  SELECT vec_id, p, e, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM x JOIN cb{n} USING (p, j) GROUP BY ALL),
at{n} AS MATERIALIZED (
  SELECT vec_id, p, min(d) AS d, arg_min(e, (d, e)) AS e FROM far{n} GROUP BY ALL)"""

    def moved(n: int) -> str:
        return f"""cb{n + 1} AS MATERIALIZED (
  SELECT p, e, j, coalesce(m, c) AS c FROM cb{n} LEFT JOIN (
    SELECT p, e, j, CAST(floor(sum(x)::HUGEINT // count(*) - CASE WHEN sum(x)::HUGEINT % count(*) < 0 THEN 1 ELSE 0 END) AS BIGINT) AS m
    FROM x JOIN at{n} USING (vec_id, p) GROUP BY ALL) USING (p, e, j))"""

    steps = ",\n".join(f"{nearest(n)},\n{moved(n)}" for n in range(rounds))
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda y: CAST(floor(4096 * CAST(y AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
x AS MATERIALIZED (
  SELECT vec_id, (i * 8) // n AS p, i % (n // 8) AS j, v[i + 1] AS x FROM (SELECT vec_id, v, len(v) AS n, unnest(range(len(v))) AS i FROM v)),
cb0 AS MATERIALIZED (
  SELECT p, e, j, x AS c FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v) USING (vec_id) WHERE e < 16),
{steps},
{nearest(rounds)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM at{rounds} GROUP BY 1),
books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM cb{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN v USING (vec_id), books"""


def quality_weights(labels: DataFrame) -> DataFrame:
    """Quality weights from labels: good 2, poor 0.5; documents without a label weigh 1."""
    return labels.where("quality in (0, 1)").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, 2.0).otherwise(0.5).alias("weight"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_exact_dedup, op3_warc_normalise, op4_toxicity, op5_html_extract, op6_ngram_jaccard, op7_chat_format, op8_embedding_dedup, op9_packing, op10_mixing,
                                 op11_lm_scores, op12_ranked_search, op13_vector_codes)}
ORACLE: dict[str, str] = {"op1_substring_dedup": OP1, "op6_ngram_jaccard": OP6, "op2_exact_dedup": OP2, "op3_warc_normalise": OP3, "op8_embedding_dedup": OP8,
                          "op12_ranked_search": OP12, "op13_vector_codes": _op13_sql()}
