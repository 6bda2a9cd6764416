"""Objects get their name only when they are complete, on every kind of filesystem."""

from types import SimpleNamespace

import pytest

from filehaul import storage
from filehaul.operators import transfer


class Recorder:
    """A filesystem in a dictionary; closing a stream publishes what it holds, as object stores do."""

    def __init__(self, type_name, renames_over=True):
        self.type_name, self.renames_over = type_name, renames_over
        self.objects, self.types, self.folders, self.failing = {}, {}, [], set()

    def create_dir(self, path, recursive=True):
        self.folders.append(path)

    def open_output_stream(self, path, metadata=None):
        self.types[path] = (metadata or {}).get("Content-Type")
        parts = []
        return SimpleNamespace(write=lambda data: parts.append(bytes(data)), close=lambda: self.objects.update({path: b"".join(parts)}))

    def move(self, old, new):
        if old in self.failing or (new in self.objects and not self.renames_over):
            raise OSError("refused")
        self.objects[new] = self.objects.pop(old)
        self.types[new] = self.types.get(old)

    def delete_file(self, path):
        del self.objects[path]

    def get_file_info(self, path):
        return SimpleNamespace(is_file=path in self.objects)


def make(monkeypatch, filesystem):
    monkeypatch.setattr(transfer, "open_filesystem", lambda uri, opened: (filesystem, uri))
    return transfer._Target("b/name", "b/_run/1", {}, set(), "application/zip")


@pytest.mark.parametrize("kind", ["s3", "gcs", "hdfs"])
def test_failed_write_leaves_the_older_object(monkeypatch, kind):
    filesystem = Recorder(kind)
    filesystem.objects["b/name"] = b"older"
    target = make(monkeypatch, filesystem)
    target.write(b"half of it")
    target.discard()
    assert filesystem.objects == {"b/name": b"older"}


@pytest.mark.parametrize("kind, renames_over", [("s3", True), ("hdfs", False), ("local", True)])
def test_publish_replaces_and_sets_the_type(monkeypatch, kind, renames_over):
    filesystem = Recorder(kind, renames_over)
    filesystem.objects["b/name"] = b"older"
    target = make(monkeypatch, filesystem)
    target.write(b"new")
    assert filesystem.objects["b/name"] == b"older"
    target.publish()
    assert filesystem.objects == {"b/name": b"new"}
    assert filesystem.types["b/name"] == "application/zip"
    assert bool(filesystem.folders) == (kind not in storage.ATOMIC_STORES)


def test_failed_rename_puts_the_older_object_back(monkeypatch):
    filesystem = Recorder("hdfs", renames_over=False)
    filesystem.objects["b/name"] = b"older"
    target = make(monkeypatch, filesystem)
    target.write(b"new")
    filesystem.failing.add("b/_run/1")
    with pytest.raises(OSError):
        target.publish()
    assert filesystem.objects["b/name"] == b"older"


def test_hadoop_names_of_stores():
    opened = {("s3", "bucket"): ("known", "bucket/")}
    assert storage.open_filesystem("s3a://bucket/a//b", opened) == ("known", "bucket/a/b")
    assert storage.open_filesystem("s3n://bucket/c", opened) == ("known", "bucket/c")
