from types import SimpleNamespace

import pytest

from verbena import session


def fake(master, conf=None, set_dir=None):
    jvm_context = SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: set_dir is not None, isEmpty=lambda: set_dir is None, get=lambda: set_dir))
    context = SimpleNamespace(master=master, _jsc=SimpleNamespace(sc=lambda: jvm_context), setCheckpointDir=lambda path: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf or default), sparkContext=context)


def test_the_shared_folder_is_never_local_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_dir(fake(master))
        assert session.shared_dir(fake(master, "hdfs:///shared/")) == "hdfs:///shared"
        assert session.shared_dir(fake(master, None, "hdfs:///set")) == "hdfs:///set"
    assert session.shared_dir(fake("local[4]")).startswith("file:///")


def test_scratch_lies_in_one_folder_of_the_application(spark):
    a, b = session.scratch(spark, "x"), session.scratch(spark, "x")
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0] == f"{session.shared_dir(spark)}/verbena-{spark.sparkContext.applicationId}"
