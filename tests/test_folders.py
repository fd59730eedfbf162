"""Tables that are folders of parts, as large ones are."""

from pyspark.sql import functions as F

from faultlens.plans.stream_queries import st9, stream_of
from faultlens.streaming import jobs


def test_streams_read_files_and_folders(spark, tmp_path):
    docs = spark.createDataFrame([(i, "src1", f"job {i} done\nnode up") for i in range(20)], "doc_id long, source string, text string")
    docs.repartition(3).write.parquet(f"{tmp_path}/parts/documents.parquet")
    docs.coalesce(1).write.parquet(f"{tmp_path}/one")
    (part,) = (tmp_path / "one").glob("part-*.parquet")
    (tmp_path / "file").mkdir()
    part.rename(tmp_path / "file" / "documents.parquet")
    for folder in ("parts", "file"):
        rows = spark.read.parquet(jobs.run_to_files(stream_of(spark, f"{tmp_path}/{folder}", "documents"), "copied"))
        assert sorted(r["doc_id"] for r in rows.collect()) == list(range(20))
        found = st9(spark, f"{tmp_path}/{folder}").agg(F.sum("n")).first()[0]
        assert found == 40
