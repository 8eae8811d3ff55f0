"""The corpus queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from helixframe.llm import boilerplate, bpe, conversations, main_text, mixing, neardup, neighbours, pii, repeats, rules, spelling, toxicity, warc
from helixframe.llm.common import table
from helixframe.session import scratch_path


def vocabulary() -> tuple[str, str]:
    """Path of the rank file and the pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.clean(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "place")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = vocabulary()
    return bpe.digests(table(spark, sf_dir, "documents"), path, pattern)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    warc.write_archive(pages, root)
    return warc.lookup(spark, root, pages.select("url"), with_payload=False)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.key_of(spark))
    return done.select("doc_id", "text", F.size("pii").cast("long").alias("n_replaced"), "pii")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scorer = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), scorer).select("doc_id", "held_out", "score", "predicted")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op11_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_nearest_vectors, op2_line_dedup, op3_quality_rules, op4_main_text, op5_source_mix, op6_bpe, op7_warc, op8_pii,
    op9_toxicity, op10_near_duplicates, op11_repeated_passages,
    op12_conversation_repair, op13_spelling_variants, pipeline)}

WHITE = r"[\x20\x09-\x0D]"
NORMAL_LINE = rf"trim(regexp_replace(lower(line), '{WHITE}+', ' ', 'g'), ' ')"

ORACLES = {
    "op1_nearest_vectors": """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sqrt(list_sum(list_transform(list_zip(q.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op2_line_dedup": f"""
WITH l AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents
), n AS (SELECT *, {NORMAL_LINE} AS form FROM l),
b AS (
  SELECT form, min(doc_id) AS first FROM n WHERE form <> '' GROUP BY form
  HAVING count(DISTINCT coalesce('=' || source, 'none')) >= {boilerplate.MIN_SITES}
), k AS (
  SELECT n.doc_id, n.text, n.line, n.i, b.first IS NOT NULL AND b.first <> n.doc_id AS gone FROM n LEFT JOIN b USING (form)
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text,
  count(*) AS n_lines, count(*) FILTER (gone) AS n_removed
FROM k GROUP BY doc_id, k.text""",
    "op3_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, 'none') AS host, coalesce(text, '') AS text FROM documents
), w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
t AS (
  SELECT r, i, concat_ws(' ', words[i], words[i + 1], words[i + 2]) AS trio
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
), again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, trio) AS n FROM t) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n_repeat FROM again, range(0, 3) g(k) GROUP BY r),
l AS (
  SELECT r, host, text, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    {NORMAL_LINE} AS form
  FROM (SELECT r, host, text, unnest(string_split(text, chr(10))) AS line FROM d)
), f AS (SELECT * FROM l WHERE n > 0),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup FROM f GROUP BY r),
frequent AS (SELECT host, form FROM f GROUP BY host, form HAVING count(DISTINCT text) > {rules.MAX_DOCS}),
stay AS (SELECT f.r, sum(n) AS n FROM f ANTI JOIN frequent USING (host, form) GROUP BY f.r),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(w.text, '{WHITE}+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(w.text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(stay.n, 0) AS BIGINT) AS left_words
  FROM w LEFT JOIN covered USING (r) LEFT JOIN dup USING (r) LEFT JOIN stay USING (r)
)
SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words)
  AND NOT (left_words < {rules.MIN_WORDS} OR left_words < {rules.MIN_SHARE} * n_words) AS kept
FROM m""",
    "op7_warc": """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), n AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS newest FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN newest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN newest <> page_id THEN newest END AS refers_to
FROM n""",
}
