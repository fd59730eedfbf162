"""Quality verdicts on all documents."""

from faultlens.llm.quality import judge
from faultlens.llm.registry import query, read


@query("op11_quality_forest")
def op11_quality_forest(spark, sf_dir):
    """Counts and verdict of every document; the thresholds come from every labelled one."""
    return judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
