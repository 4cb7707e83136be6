"""Where intermediate tables go, and an entry without the optional operators."""

import os
import subprocess
import sys

import pytest

from goldweave import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


class Session:
    """Stands for a session of which only the settings are read."""

    def __init__(self, **conf):
        self.conf = conf


def test_the_shared_folder(monkeypatch):
    monkeypatch.setattr(session, "_on_disk", lambda spark, folder: folder.startswith("file:"))
    house = {"spark.sql.warehouse.dir": "file:/house/"}
    named = {"spark.checkpoint.dir": "file:/shared/"} | house
    yarn = {"spark.master": "yarn"}
    assert session.shared_folder(Session(**named, **yarn)) == "file:/shared"
    assert session.shared_folder(Session(**house, **{"spark.master": "local[2]"})) == "file:/house"
    assert session.shared_folder(Session(**yarn, **{"spark.sql.warehouse.dir": "hdfs:/house"})) == "hdfs:/house"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session(**house, **yarn))
    monkeypatch.setattr(session, "_set_on_context", lambda spark: "hdfs:/set")
    assert session.shared_folder(Session(**house, **yarn)) == "hdfs:/set"


def test_which_folders_are_on_disk(spark):
    assert session._on_disk(spark, "/tmp/x") and session._on_disk(spark, "file:/tmp/x")


def test_entry_without_the_optional_libraries():
    code = ("import sys; sys.modules['xxhash'] = None; sys.modules['regex'] = None; sys.modules['tokenizers'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); assert 'insert_new' in q; assert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
