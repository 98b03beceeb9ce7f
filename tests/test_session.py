"""The scratch folder of a session that names none, and of one that does."""

import os

from chatsieve.session import scratch_path, shared_dir


class Plain:
    """As much of a session as the folder is asked of."""

    def __init__(self, configured=None, master="local[2]", app="app-1"):
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": app})()


def test_a_named_folder_is_used():
    assert shared_dir(Plain("file:///shared/x/")) == "file:///shared/x"
    assert scratch_path(Plain("/shared"), "a").startswith("/shared/chatsieve/a-")


def test_a_local_session_keeps_one_folder():
    session = Plain()
    assert os.path.isdir(shared_dir(session)) and shared_dir(session) == shared_dir(session)
    assert shared_dir(Plain(app="app-2")) != shared_dir(session)


def test_a_cluster_must_name_one():
    try:
        shared_dir(Plain(master="yarn"))
    except ValueError as error:
        assert "spark.checkpoint.dir" in str(error)
    else:
        raise AssertionError("no error")
