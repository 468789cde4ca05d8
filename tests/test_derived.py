from pyspark.sql import functions as F

from tidewater.sources.derived import derived
from tidewater.sources.fs import clear_scratch


def test_made_once_until_the_folder_changes_or_scratch_is_cleared(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.read.parquet(f"{tmp_path}/a.parquet").agg(F.sum("id").alias("s"))

    spark.range(10).write.parquet(f"{tmp_path}/a.parquet")
    get = lambda: derived(spark, str(tmp_path), "sum", make).first()["s"]
    assert (get(), get(), len(made)) == (45, 45, 1)
    spark.range(5).write.mode("overwrite").parquet(f"{tmp_path}/a.parquet")
    assert (get(), len(made)) == (10, 2)
    assert clear_scratch(spark) > 0
    assert (get(), get(), len(made)) == (10, 10, 3)
