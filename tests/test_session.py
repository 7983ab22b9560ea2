from sluice import session as S


def test_landed_path_writes_once_per_source(spark, tmp_path):
    src_path = str(tmp_path / "src")
    spark.range(10).write.parquet(src_path)
    src = spark.read.parquet(src_path)
    calls = []

    def write(p):
        calls.append(p)
        src.write.mode("overwrite").parquet(p)

    a = S.landed_path(spark, "t", src, write)
    b = S.landed_path(spark, "t", src, write)
    assert a == b and len(calls) == 1
    spark.range(20).write.mode("append").parquet(src_path)
    c = S.landed_path(spark, "t", spark.read.parquet(src_path), write)
    assert c != a and len(calls) == 2
