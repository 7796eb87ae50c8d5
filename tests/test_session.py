from estate_hygiene import session


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Context:
    applicationId = "app-under-test"

    def __init__(self, master):
        self.master = master


class Session:
    def __init__(self, master, **conf):
        self.sparkContext = Context(master)
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})


def test_the_folder_named_by_the_cluster_is_used():
    assert session.shared_folder(Session("yarn", spark_checkpoint_dir="hdfs:///shared")) == "hdfs:///shared"


def test_a_cluster_without_a_folder_is_refused():
    try:
        session.shared_folder(Session("spark://host:7077"))
    except RuntimeError as refused:
        assert "spark.checkpoint.dir" in str(refused)
    else:
        raise AssertionError("a machine-local folder was accepted")


def test_a_local_session_gets_one_temporary_folder():
    local = Session("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)


def test_the_setting_of_a_real_session_is_found(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert spark.conf.get("spark.checkpoint.dir", None) == configured
    if configured:
        assert session.shared_folder(spark) == configured
