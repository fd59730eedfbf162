"""Benchmark leaks and repeated lines of all documents."""

from faultlens.llm.decontam import find_leaks
from faultlens.llm.line_dedup import dedup_lines
from faultlens.llm.registry import query, read


@query("op2_decontaminate")
def op2_decontaminate(spark, sf_dir):
    """Every test item found in a document, with its distance and place."""
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op6_line_dedup")
def op6_line_dedup(spark, sf_dir):
    """Every document with the text that is left and the number of lines taken out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, lost="n_lost")
