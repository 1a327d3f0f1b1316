import os

import pytest

import __spark_entry__ as entry
from quire.plans import registry
from quire.session import shared_dir

D = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(D), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_queries_run(spark, name):
    df = entry.queries()[name](spark, D)
    assert len(set(df.columns)) == len(df.columns)
    df.write.format("noop").mode("overwrite").save()


def test_sql_has_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert registry.QUERIES.keys() <= entry.queries().keys()


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(Conf)
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        shared_dir(Session())
