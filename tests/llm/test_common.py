import pytest

from shelfline.llm import common
from shelfline.llm.common import free_name, materialize, materialize_alone, named, remove_scratch, shared_dir


def folders(spark):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {x.getPath().getName() for x in fs.listStatus(path)} if fs.exists(path) else set()


def test_files_on_the_way_go(spark):
    before = folders(spark)

    def make():
        return materialize(materialize(spark.range(5), "one"), "two").where("id > 1")

    out = materialize_alone(make, "three")
    left = folders(spark) - before
    assert len(left) == 1 and next(iter(left)).startswith("three-") and out.count() == 3
    remove_scratch(spark, common._MADE[-1:])
    assert folders(spark) == before


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b``c` int, x int")
    assert df.select(named("a.b`c")).first()[0] == 1 and free_name(df, "X") == "_X" and free_name(df, "y") == "y"


def test_a_cluster_must_name_its_folder():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            master = "local-cluster[3,2,1000]"

    with pytest.raises(ValueError):
        shared_dir(Session)
    for master in ("local", "local[*]", "local[4]"):
        Session.sparkContext.master = master
        assert shared_dir(Session) == common.LOCAL_SHARED
