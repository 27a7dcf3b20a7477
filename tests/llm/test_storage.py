import pytest
from pyarrow import fs as pafs

from tallow.llm import common as C


def test_schemes():
    assert C.filesystem("file:/a/b")[1] == C.filesystem("file:///a/b")[1] == "/a/b"
    with pytest.raises(ValueError, match="names no file system"):
        C.filesystem("/a/b")


def test_s3_names_of_hadoop(monkeypatch):
    asked = []

    class Store:
        @staticmethod
        def from_uri(uri):
            asked.append(uri)
            return None, uri
    monkeypatch.setattr(C.pafs, "FileSystem", Store)
    for uri in ("s3a://bucket/x", "s3n://bucket/x", "s3://bucket/x", "hdfs://name/x"):
        C.filesystem(uri)
    assert asked == ["s3://bucket/x"] * 3 + ["hdfs://name/x"]


def test_paths_get_the_scheme_of_sparks_store(spark):
    assert C.qualified(spark, "/a/b") == "file:/a/b"
    assert C.qualified(spark, "file:///a/b") in ("file:/a/b", "file:///a/b")
    assert C.shared_folder(spark, "llm", "x").startswith("file:")


def test_a_dropped_table_leaves_no_folder(spark):
    t = C.materialize(spark.range(3), "short")
    fs, p = C.filesystem(t._tallow_path)
    assert fs.get_file_info(p).type == pafs.FileType.Directory
    assert sorted(C.read_shared(t._tallow_path).column("id").to_pylist()) == [0, 1, 2]
    C.drop_table(t)
    assert fs.get_file_info(p).type == pafs.FileType.NotFound
