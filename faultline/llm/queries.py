"""The queries of this folder's operators, as the driver calls them."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.llm import (
    brown_lm, byte_bpe, chat_format, decontam, embed_dedup, filter_audit, fim, html_extract, langid, mixing, ngram_join,
    secrets, toxicity,
)
from faultline.llm.common import held_out, prepare, read_table


def op1_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    return toxicity.score_corpus(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_brown_lm(spark, sf_dir):
    return brown_lm.score_corpus(read_table(spark, sf_dir, "documents"))


def op4_decontamination(spark, sf_dir):
    got = decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                      decontam.items_digest().alias("items_sha256"), "contaminated")


def op5_secret_scan(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(secrets.findings_from(docs)))


def op6_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    got = langid.predict(docs, langid.fit(langid.training_rows(docs)))
    return got.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score")


def op7_byte_bpe(spark, sf_dir):
    return byte_bpe.digest(byte_bpe.encode(read_table(spark, sf_dir, "documents"), decoded=True))


def op8_html_extraction(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return html_extract.extract_pages(pages, html_extract.fit(pages)).select("page_id", "url", "text", "n_chars")


def op9_chat_format(spark, sf_dir):
    rows = chat_format.with_probe(read_table(spark, sf_dir, "conversations"))
    return chat_format.read_back(chat_format.format_conversations(rows))


def op10_embedding_dedup(spark, sf_dir):
    return embed_dedup.cosine_components(read_table(spark, sf_dir, "embeddings"))


def op11_fill_in_middle(spark, sf_dir):
    return fim.digest(fim.restore(fim.fill_in_middle(read_table(spark, sf_dir, "documents"))))


def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit(filter_audit.failure_cells(read_table(spark, sf_dir, "documents"),
                                                         read_table(spark, sf_dir, "labels")))


def op13_source_mix(spark, sf_dir):
    return mixing.mixture(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_toxicity, op3_brown_lm, op4_decontamination, op5_secret_scan, op6_language_id,
    op7_byte_bpe, op8_html_extraction, op9_chat_format, op10_embedding_dedup, op11_fill_in_middle,
    op12_filter_audit, op13_source_mix, pipeline)}


def all_queries():
    def wrap(fn):
        def run(spark, sf_dir):
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        return run
    return {k: wrap(f) for k, f in QUERIES.items()}
