from starledger.operators.keys import surrogate_key
from starledger.session import releasing, shared_folder


def folders(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/starledger/{spark.sparkContext.applicationId}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()


def test_staged_copies_go_once_the_result_is_stored(spark):
    before = folders(spark)
    with releasing(spark):
        keyed = surrogate_key(spark.range(20).toDF("v"), ["v"], "key")
        assert len(folders(spark) - before) == 1
        assert keyed.where("key = v + 1").count() == 20
    assert folders(spark) == before
