"""Lines of dimensions are rendered by as many tasks as there are cores."""

from ledgerline.sources.render import render_lines


def test_one_file_of_a_dimension_is_dealt_to_tasks(spark, tmp_path):
    spark.createDataFrame([(i, f"s{i}", i % 5) for i in range(12)], "s_suppkey bigint, s_name string, s_nationkey int"
                          ).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(i, f"c{i}", i % 5, 1.5 * i) for i in range(12)], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double"
                          ).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    adaptive = "spark.sql.adaptive.enabled"
    before = spark.conf.get(adaptive)
    spark.conf.set(adaptive, "false")
    try:
        for table in ("weball", "cn", "cm", "ccl"):
            lines = render_lines(spark, str(tmp_path), table)
            assert lines.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
            assert lines.count() == {"ccl": 44, "cm": 48}.get(table, 48)
    finally:
        spark.conf.set(adaptive, before)
