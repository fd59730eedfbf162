"""Toxicity of all documents."""

from faultlens.llm.registry import query, read
from faultlens.llm.toxicity import score, train


@query("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    """The score of every document by a classifier that has not seen the held-out labels; a null text scores like an empty one."""
    docs = read(spark, sf_dir, "documents")
    return score(docs, train(docs, read(spark, sf_dir, "labels")))
