import pytest

from wardline import session


def test_one_folder_per_application(spark):
    assert len({session.ensure_checkpoint_dir(spark) for _ in range(10)}) == 1


def test_a_cluster_must_name_its_folder(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Sc:
        applicationId, master = "app-none", "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                class J:
                    @staticmethod
                    def getCheckpointDir():
                        class O:
                            @staticmethod
                            def isDefined():
                                return False
                        return O()
                return J()

    class Spark:
        conf, sparkContext = Conf(), Sc()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Spark())


def test_stored_cuts_the_lineage(spark):
    df = session.stored(spark.range(5).selectExpr("id", "id * 2 AS twice"), "t")
    assert df.schema.names == ["id", "twice"] and df.count() == 5
    assert "parquet" in df._jdf.queryExecution().optimizedPlan().toString().lower()
