"""The operators as queries over the tables of one folder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm import (
    alignment, codes, embeddings, exact, html, language, mixing, packing, quality, repeats,
    sharding, simhash, toxicity)
from fieldtally.llm.common import in_fold, table

SHARDS = 40
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@_query
def op1_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of nearly equal numbers of rows, each with the whole's mix."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.shard_documents(rows, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")


@_query
def op2_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality; learned from four of five parts of the labelled ids."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = in_fold(F.col("doc_id"), 5) == 0
    model = quality.train(docs, labels, ~held_out)
    return quality.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query
def op3_scheduled_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes, and its source's target."""
    sources, spans = mixing.mix(table(spark, sf_dir, "documents"))
    taken = spans.groupBy("doc_id", "source", "source_key", "size", "copy").agg(
        F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("taken"))
    return mixing.by_source(taken, sources).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", "source")


@_query
def op4_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint of 4-word shingles and its component of near ones."""
    found = simhash.simhash_dedup(table(spark, sf_dir, "documents"), shingle=4, most_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@_query
def op5_hyperplane_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links of cosine 0.95 and more, and its component."""
    return embeddings.embedding_dedup(table(spark, sf_dir, "embeddings"))


@_query
def op6_exact_tree_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of each group of equal texts stays."""
    return exact.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


@_query
def op7_unlabelled_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity; learned from four of five parts of the ids."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = in_fold(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs, labels, ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query
def op8_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces in which all documents fill sequences of 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


@_query
def op9_segmented_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; learned from two of three parts of the ids."""
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 3) == 1
    model = language.train(docs, ~held_out)
    return language.identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


@_query
def op10_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return html.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@_query
def op11_dual_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code in 16 codebooks of 64 entries, and its error."""
    return codes.compress_vectors(table(spark, sf_dir, "embeddings"), 16, 64, 2)


@_query
def op12_induced_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its strings of 400 bytes that occur elsewhere."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), 400).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@_query
def op13_anchored_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two vocabularies lie on each document's bytes."""
    return alignment.align_tokens(table(spark, sf_dir, "documents"))[0]


_SPACES = r"[\x20\x09-\x0D]"

ORACLES: dict[str, str] = {
    "op6_exact_tree_merge": rf"""
        WITH bare AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   sha256(regexp_replace(coalesce(text, ''), '{_SPACES}', '', 'g')) AS text_sha256
            FROM documents),
        kept AS (
            SELECT *, first_value(doc_id) OVER w AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM bare WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id))
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM kept""",
    # The stream of a source is its documents in the order of each epoch, end to end; the
    # slots that the schedule gives it take the stream's first words.
    "op3_scheduled_mix": r"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, source, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
            FROM documents),
        sizes AS (
            SELECT k, sum(size)::BIGINT AS source_size,
                   (row_number() OVER (ORDER BY k) - 1) % 3 + 1.0::DOUBLE AS weight
            FROM docs GROUP BY k),
        whole AS (SELECT sum(source_size)::DOUBLE AS words FROM sizes),
        fill AS (
            SELECT 0 AS round, k, source_size, weight, false AS full_up FROM sizes
            UNION ALL
            SELECT round + 1, k, source_size, weight, full_up OR
                   3.0 * source_size <= weight * (words - coalesce(sum(3.0 * source_size)
                       FILTER (full_up) OVER (), 0)) / nullif(sum(weight)
                       FILTER (NOT full_up) OVER (), 0)
            FROM fill, whole WHERE round < 30),
        targets AS (
            SELECT k, source_size, CASE WHEN full_up THEN 3.0 * source_size ELSE
                   weight * (words - coalesce(sum(3.0 * source_size) FILTER (full_up) OVER (), 0))
                   / sum(weight) FILTER (NOT full_up) OVER () END::DOUBLE AS target
            FROM fill, whole WHERE round = 30),
        bounds AS (
            SELECT k, CASE WHEN lead(k) OVER (ORDER BY k) IS NULL THEN 2147483648 ELSE
                   round(sum(share) OVER (ORDER BY k) * 2147483648)::BIGINT END AS hi
            FROM (SELECT k, target / sum(target) OVER () AS share FROM targets WHERE target > 0)),
        points AS (
            SELECT (i % 2147483648) * 1327217885 % 2147483648 AS point
            FROM (SELECT unnest(range(0, ((SELECT words FROM whole)::BIGINT + 127) // 128)) AS i)),
        slots AS (
            SELECT b.k, count(*) * 128 AS words
            FROM points p ASOF JOIN (SELECT k, coalesce(lag(hi) OVER (ORDER BY hi), 0) AS lo
                                     FROM bounds) b ON p.point >= b.lo GROUP BY b.k),
        stream AS (
            SELECT d.*, e.epoch, coalesce(sum(size) OVER (
                       PARTITION BY d.k ORDER BY e.epoch, substr(md5('30:' || e.epoch || ':' ||
                       d.doc_id), 1, 15), d.doc_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM docs d, (SELECT unnest([0, 1, 2]) AS epoch) e),
        taken AS (
            SELECT doc_id, any_value(source) AS source, s.k, any_value(size) AS size,
                   sum(greatest(0, least(size, coalesce(words, 0) - before)))::BIGINT AS taken
            FROM stream s LEFT JOIN slots USING (k) GROUP BY doc_id, s.k)
        SELECT doc_id, size, source_size, round(target, 6) AS target, taken, source FROM taken JOIN targets USING (k)""",
    # Windows of 400 bytes by their MD5; runs of covered bytes are cut out.
    "op12_induced_repeats": """
        WITH bodies AS (
            SELECT row_number() OVER () AS nr, doc_id, encode(coalesce(text, '')) AS b FROM documents),
        starts AS (
            SELECT nr, unnest(range(1, octet_length(b) - 398)) AS i, unnest(list_transform(
                range(1, octet_length(b) - 398), lambda i: md5_number(array_slice(b, i, i + 399)))) AS h
            FROM bodies),
        windows AS (SELECT nr, i FROM starts WHERE h IN (
            SELECT h FROM starts GROUP BY h HAVING count(*) > 1)),
        hits AS (
            SELECT nr, i, lag(i) OVER (PARTITION BY nr ORDER BY i) AS earlier FROM windows),
        runs AS (
            SELECT nr, i, sum((earlier IS NULL OR i > earlier + 400)::INT)
                   OVER (PARTITION BY nr ORDER BY i) AS run FROM hits),
        spans AS (
            SELECT nr, run, min(i) AS first, max(i) + 399 AS last FROM runs GROUP BY nr, run),
        lists AS (
            SELECT nr, sum(last - first + 1)::BIGINT AS n_removed, count(*) AS n_spans,
                   list(first ORDER BY first) AS firsts, list(last ORDER BY first) AS lasts
            FROM spans GROUP BY nr)
        SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
               coalesce(n_spans, 0) AS n_spans,
               CASE WHEN n_spans IS NULL THEN sha256(b) ELSE sha256(unhex(list_reduce(list_transform(
                   range(1, n_spans + 2), lambda k: hex(array_slice(b,
                       CASE WHEN k = 1 THEN 1 ELSE lasts[k - 1] + 1 END,
                       CASE WHEN k > n_spans THEN octet_length(b) ELSE firsts[k] - 1 END))),
                   lambda x, y: x || y))) END AS kept_sha256
        FROM bodies LEFT JOIN lists USING (nr)""",
    # Parts of four components each, as the vectors of the table have 64.
    "op11_dual_tree_codes": """
        WITH kept AS (
            SELECT row_number() OVER (ORDER BY vec_id, embedding) AS nr, vec_id, label, embedding
            FROM embeddings WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        points AS (
            SELECT nr, p, floor(256 * embedding[4 * p + 1]::DOUBLE)::BIGINT AS x1,
                   floor(256 * embedding[4 * p + 2]::DOUBLE)::BIGINT AS x2,
                   floor(256 * embedding[4 * p + 3]::DOUBLE)::BIGINT AS x3,
                   floor(256 * embedding[4 * p + 4]::DOUBLE)::BIGINT AS x4
            FROM (SELECT nr, embedding, unnest(range(16)) AS p FROM kept)),
        book0 AS (
            SELECT p, nr - 1 AS e, x1 AS c1, x2 AS c2, x3 AS c3, x4 AS c4 FROM points WHERE nr <= 64),
        book1 AS (
            SELECT p, e, coalesce(m1, c1) AS c1,
                   coalesce(m2, c2) AS c2,
                   coalesce(m3, c3) AS c3,
                   coalesce(m4, c4) AS c4
            FROM book0 LEFT JOIN (
                SELECT p, e, floor(sum(x1)::DOUBLE / count(*))::BIGINT AS m1, floor(sum(x2)::DOUBLE / count(*))::BIGINT AS m2, floor(sum(x3)::DOUBLE / count(*))::BIGINT AS m3, floor(sum(x4)::DOUBLE / count(*))::BIGINT AS m4
                FROM points JOIN (
            SELECT nr, p, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM (
                SELECT nr, p, e, (x1 - c1) * (x1 - c1) + (x2 - c2) * (x2 - c2)
                       + (x3 - c3) * (x3 - c3) + (x4 - c4) * (x4 - c4) AS d
                FROM points JOIN book0 USING (p)) GROUP BY nr, p) USING (nr, p) GROUP BY p, e) USING (p, e)),
        book2 AS (
            SELECT p, e, coalesce(m1, c1) AS c1,
                   coalesce(m2, c2) AS c2,
                   coalesce(m3, c3) AS c3,
                   coalesce(m4, c4) AS c4
            FROM book1 LEFT JOIN (
                SELECT p, e, floor(sum(x1)::DOUBLE / count(*))::BIGINT AS m1, floor(sum(x2)::DOUBLE / count(*))::BIGINT AS m2, floor(sum(x3)::DOUBLE / count(*))::BIGINT AS m3, floor(sum(x4)::DOUBLE / count(*))::BIGINT AS m4
                FROM points JOIN (
            SELECT nr, p, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM (
                SELECT nr, p, e, (x1 - c1) * (x1 - c1) + (x2 - c2) * (x2 - c2)
                       + (x3 - c3) * (x3 - c3) + (x4 - c4) * (x4 - c4) AS d
                FROM points JOIN book1 USING (p)) GROUP BY nr, p) USING (nr, p) GROUP BY p, e) USING (p, e)),
        coded AS (
            SELECT nr, string_agg(printf('%02x', e::INT), '' ORDER BY p) AS code,
                   sum(d)::BIGINT AS error
            FROM (
            SELECT nr, p, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM (
                SELECT nr, p, e, (x1 - c1) * (x1 - c1) + (x2 - c2) * (x2 - c2)
                       + (x3 - c3) * (x3 - c3) + (x4 - c4) * (x4 - c4) AS d
                FROM points JOIN book2 USING (p)) GROUP BY nr, p) GROUP BY nr)
        SELECT vec_id, label, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
               (SELECT sha256(string_agg(concat_ws(',', c1, c2, c3, c4), ',' ORDER BY p, e))
                FROM book2) AS codebooks_sha256
        FROM kept JOIN coded USING (nr)""",
}
