"""All documents packed into sequences of 2,048 tokens."""

from faultlens.llm.packing import pack
from faultlens.llm.registry import query, read


@query("op7_pack")
def op7_pack(spark, sf_dir):
    """Every piece of every document with its place; null and empty texts are pieces of the end id alone."""
    return pack(read(spark, sf_dir, "documents"))
