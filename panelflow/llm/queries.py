"""Queries of the training-data operators over the given tables."""

from __future__ import annotations

from panelflow.llm import align, bpe, decontaminate, html, lines, lm, ngrams, pii, quality, search, simhash, substring, toxicity
from panelflow.llm.common import table
from panelflow.llm.oracles import ORACLE_SQL  # noqa: F401

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_line_dedup(spark, d):
    return lines.report(table(spark, d, "documents"))


@query
def op2_substring_dedup(spark, d):
    return substring.report(table(spark, d, "documents"))


@query
def op3_toxicity(spark, d):
    return toxicity.report(table(spark, d, "documents"), table(spark, d, "labels"))


@query
def op4_decontaminate(spark, d):
    return decontaminate.report(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op5_quality(spark, d):
    return quality.report(table(spark, d, "documents"))


@query
def op6_pii(spark, d):
    return pii.report(table(spark, d, "documents"))


@query
def op7_lm_score(spark, d):
    return lm.report(table(spark, d, "documents"))


@query
def op8_bpe(spark, d):
    return bpe.round_trip(table(spark, d, "documents")).drop("ids")


@query
def op9_html(spark, d):
    return html.extract_main_text(table(spark, d, "pages"))


@query
def op10_simhash(spark, d):
    return simhash.simhash_components(table(spark, d, "documents"))


@query
def op11_ngram_join(spark, d):
    return ngrams.report(table(spark, d, "documents"))


@query
def op12_search(spark, d):
    return search.report(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op13_align(spark, d):
    return align.report(table(spark, d, "documents"))


@query
def pipeline(spark, d):
    import corpus_pipeline
    return corpus_pipeline.run(spark, d).drop("ids")
