"""License marks of all documents."""

from faultlens.llm.licenses import scan
from faultlens.llm.registry import query, read


@query("op9_licenses")
def op9_licenses(spark, sf_dir):
    """The license marks of every document; null and empty texts have none."""
    return scan(read(spark, sf_dir, "documents"))
