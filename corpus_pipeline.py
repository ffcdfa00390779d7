"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run``
writes each result as Parquet in the shared checkpoint folder and reads it again.

1. language ID: documents without a letter, or of no language, go;
2. line de-duplication: of each class of equal or similar lines the first stays;
3. SimHash near-duplicates: of each component the document with the smallest doc_id stays;
4. benchmark decontamination: documents that hold a benchmark passage go;
5. packing into sequences of 2,048 tokens (one row per piece).
"""

from __future__ import annotations

from starforge.llm import decontaminate, langid, linededup, packing, simhash
from starforge.llm.common import crc32_remainder, documents, stage
from starforge.llm.queries import vocabulary


def language_id(spark, docs, sf_dir):
    return langid.keep_identified(docs, crc32_remainder("doc_id", 4) != 2, least=0.35)


def line_dedup(spark, docs, sf_dir):
    return linededup.keep_first_lines(docs, threshold=0.8)


def near_dedup(spark, docs, sf_dir):
    return simhash.keep_first(docs, distance=2, shingle=3)


def decontamination(spark, docs, sf_dir):
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_packing(spark, docs, sf_dir):
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end=1, window=2048)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", token_packing)]

ORACLE_SQL = None           # MinHash bands, trained models and tokenizers have no SQL


def run(spark, sf_dir):
    docs = documents(spark, sf_dir)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
