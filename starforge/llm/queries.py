"""The registered queries op1_ to op13_ and their SQL, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from starforge.llm import (backoff, decontaminate, filteraudit, langid, lexical, linededup, minhash, packing, planes,
                           quality, sharding, simhash, toxicity)
from starforge.llm.common import crc32_remainder, documents
from starforge.session import scratch_path


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_minhash_fingerprints(spark, sf_dir):
    return minhash.fingerprints(documents(spark, sf_dir), threshold=0.8)


def op2_bit_plane_ids(spark, sf_dir):
    path = scratch_path(spark, "planes")
    planes.write_ids(documents(spark, sf_dir), path, vocabulary("word_bpe_49k.json"), end=2, unit="byte")
    return planes.read_ids(spark, path)


def op3_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(documents(spark, sf_dir), distance=2, shingle=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_ring_sharding(spark, sf_dir):
    placed = sharding.shard(documents(spark, sf_dir), shards=8, nodes=64)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "home")


def op5_differencing_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), end=1, window=2048)


def op6_toxic_sentences(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, crc32_remainder("doc_id", 3) != 1)
    held = F.coalesce(crc32_remainder("doc_id", 3) == 1, F.lit(False))
    return toxicity.score(docs, model, decision=0.7).select(
        "doc_id", held.alias("held_out"), "score", "predicted", "sentence_begin", "sentence_end", "sentence_score")


def op7_line_dedup(spark, sf_dir):
    return linededup.line_classes(documents(spark, sf_dir), threshold=0.8)


def op8_stupid_backoff(spark, sf_dir):
    return backoff.scores(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), order=3, backoff=0.4)


def op9_qgram_decontamination(spark, sf_dir):
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_crf_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = langid.train(docs, crc32_remainder("doc_id", 4) != 2)
    held = F.coalesce(crc32_remainder("doc_id", 4) == 2, F.lit(False))
    return langid.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op11_ngram_quality(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, crc32_remainder("doc_id", 5) != 0)
    held = F.coalesce(crc32_remainder("doc_id", 5) == 0, F.lit(False))
    return quality.score(docs, model, decision=0.3).select(
        "doc_id", held.alias("held_out"), "score", "predicted", "features")


def op12_treap_search(spark, sf_dir):
    return lexical.ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), top=10)


def op13_filter_audit(spark, sf_dir):
    return filteraudit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {
    "op1_minhash_fingerprints": op1_minhash_fingerprints,
    "op2_bit_plane_ids": op2_bit_plane_ids,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_ring_sharding": op4_ring_sharding,
    "op5_differencing_packing": op5_differencing_packing,
    "op6_toxic_sentences": op6_toxic_sentences,
    "op7_line_dedup": op7_line_dedup,
    "op8_stupid_backoff": op8_stupid_backoff,
    "op9_qgram_decontamination": op9_qgram_decontamination,
    "op10_crf_language_id": op10_crf_language_id,
    "op11_ngram_quality": op11_ngram_quality,
    "op12_treap_search": op12_treap_search,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op12_treap_search": """
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents),
        held AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
        sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
        total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM held, total GROUP BY term),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        scored AS (
            SELECT item_id, doc_id,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))
                        AS BIGINT) AS score
            FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), total
            GROUP BY item_id, doc_id),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
            FROM scored WHERE score > 0)
        SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM placed WHERE place <= 10""",
    "op13_filter_audit": """
        WITH texts AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        marks AS (
            SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
        failing AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
                   || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
                   || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
                   || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                   || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
            FROM texts LEFT JOIN marks USING (doc_id)),
        cells AS (
            SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
            FROM failing GROUP BY part, fails),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        steps AS (
            SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS filter,
                   substr(filter_order, 1, step - 1) AS before
            FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
        met AS (
            SELECT part, filter_order, step, filter, fails, n, good, toxic, contains(fails, filter) AS hit,
                   translate(fails, before, '') = fails AS reached
            FROM cells, steps),
        counted AS (
            SELECT part, filter_order, step, filter,
                   coalesce(sum(n) FILTER (reached AND NOT hit), 0) AS kept,
                   coalesce(sum(n) FILTER (reached AND hit), 0) AS removed,
                   coalesce(sum(n) FILTER (hit AND NOT reached), 0) AS redundant,
                   coalesce(sum(n) FILTER (fails = filter), 0) AS unique_fails,
                   coalesce(sum(good) FILTER (reached AND hit), 0) AS good_lost,
                   coalesce(sum(toxic) FILTER (reached AND hit), 0) AS toxic_lost
            FROM met GROUP BY part, filter_order, step, filter)
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
        FROM counted""",
}
