"""Tasks of a load get few enough wide rows to sort them in memory."""

from goldweave import session


def test_tasks_are_small_and_settings_are_put_back(spark, tmp_path):
    path = f"file://{tmp_path}/rows"
    spark.range(4_000_000).repartition(1).write.option("parquet.block.size", 1 << 20).parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "rows").glob("*.parquet"))
    assert size > 12 << 20
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with session.load_settings(spark):
        assert spark.read.parquet(path).rdd.getNumPartitions() >= size // (4 << 20)
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32MB"
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
