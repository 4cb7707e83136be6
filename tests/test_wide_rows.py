"""What a load spares: copies of wide rows, statistics that nobody reads."""

import pytest
from pyspark.sql import functions as F

from goldweave import session
from goldweave.operators.collapse import MergeSource, collapse_many
from goldweave.sources.snapshot import Store


def source(spark, **options):
    rows = spark.createDataFrame(
        [("a", 2, "x", "p"), ("a", 1, "z", None), ("a", 1, None, "q"), ("b", None, "y", "r"), (None, 1, "n", "n")],
        "k string, o int, u string, i string")
    return MergeSource("s", rows, update=["u"], insert=["k", "u", "i"], **options)


@pytest.mark.parametrize("order, first, last", [((), "q", "z"), (("o",), "q", "x")])
def test_first_and_last_row_are_taken_of_one_copy(spark, order, first, last):
    one = collapse_many([source(spark, order=order)], ["k"])
    got = {r["k"]: r for r in one.collect()}
    assert set(got) == {"a", "b"}
    assert got["a"]["_first_s"]["i"] == first and got["a"]["_last_s"]["u"] == last
    assert got["b"]["_first_s"] == got["b"]["_last_s"] and got["a"]["_rows_s"] == 3
    plan = one._jdf.queryExecution().analyzed().toString()
    assert len([x for x in plan.splitlines() if "Project" in x and "struct(" in x]) == 1
    assert plan.count("struct(") == 1


def test_rows_ranked_in_two_ways_keep_both(spark):
    one = collapse_many([source(spark, first_by=["o"], last_by=["u"])], ["k"])
    row = one.where("k = 'a'").first()
    assert row["_first_s"]["o"] == 1 and row["_last_s"]["u"] == "z"
    assert one._jdf.queryExecution().analyzed().toString().count("struct(") == 2


def has_statistics(spark, folder):
    """Whether the footer of a Parquet folder has minima and maxima of its first column."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    files = path.getFileSystem(conf).listStatus(path)
    name = next(f.getPath() for f in files if f.getPath().getName().endswith(".parquet"))
    read = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(name, conf))
    try:
        return read.getFooter().getBlocks().get(0).getColumns().get(0).getStatistics().hasNonNullValue()
    finally:
        read.close()


def test_staged_tables_have_no_statistics_and_published_ones_do(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k")).coalesce(1)
    staged = session.staged(rows, "wide")
    assert sorted(r[0] for r in staged.collect()) == sorted(str(n) for n in range(1000))
    assert not has_statistics(spark, staged.inputFiles()[0].rsplit("/", 1)[0])
    written = Store(spark, f"file://{tmp_path}/store").write(rows, "t", "r")
    assert has_statistics(spark, written.path)


def test_a_load_generates_no_method_that_is_only_interpreted(spark):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    with session.load_settings(spark):
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before
