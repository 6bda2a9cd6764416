import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from filehaul.sources import chunks, listing

TREE = {
    "a.txt": b"a",
    "sub/b.txt": b"bb",
    "sub/deep/c.txt": b"ccc",
    "sp ace.txt": b"dddd",
    "zero.txt": b"",
    ".hidden": b"h",
    "_under": b"u",
    ".hid/z.txt": b"zz",
    ".a.txt.crc": b"checksum side file",
}
FILES = {path: len(content) for path, content in TREE.items() if not path.endswith(".crc")}


def found(files):
    return sorted((row["relativePath"], row["fileSize"]) for row in files.collect())


def test_recursive_listing(spark, make_tree):
    root = make_tree(TREE)
    os.mkdir(f"{root}/empty")
    files = listing.list_files(spark, root)
    assert found(files) == sorted((f"source/{path}", size) for path, size in FILES.items())
    assert found(listing.list_files(spark, root + "/")) == sorted(FILES.items())
    row = files.where("fileName = 'c.txt'").first()
    assert row["fullPath"] == f"{root}/sub/deep/c.txt"
    assert row["hostURI"] == "file:/" and row["isDir"] is False
    assert row["modificationTime"].timestamp() == pytest.approx(
        os.stat(f"{root}/sub/deep/c.txt").st_mtime, abs=1e-5
    )


def test_non_recursive_listing(spark, make_tree):
    root = make_tree(TREE) + "/"
    direct = {path: size for path, size in FILES.items() if "/" not in path}
    assert found(listing.list_files(spark, root, recursive=False)) == sorted(direct.items())
    below = listing.direct_children(listing.list_files(spark, root), root)
    assert found(below) == sorted(direct.items())


def test_many_roots(spark, make_tree):
    root = make_tree(TREE)
    files = listing.list_files(spark, f"{root}/,{root}/sub/,{root}/a.txt,{root}/missing")
    expected = list(FILES.items()) + [("b.txt", 2), ("deep/c.txt", 3), ("a.txt", 1)]
    assert found(files) == sorted(expected)
    entries = listing.scan_tree(spark, f"{root}/,{root}/missing")
    assert [row["root"] for row in listing.missing_roots(entries).collect()] == [f"{root}/missing"]


def test_only_missing_roots(spark, tmp_path):
    assert listing.list_files(spark, f"{tmp_path}/none,{tmp_path}/nothing").count() == 0


def test_roots_are_not_trimmed(spark, make_tree):
    root = make_tree({"a": b"1"})
    with pytest.raises(ValueError):
        listing.list_files(spark, f"{root}, {root}")
    with pytest.raises(ValueError):
        listing.list_files(spark, f"file:{root}")
    with pytest.raises(ValueError):
        listing.list_files(spark, root, scheme="s3")


def test_root_that_the_filesystem_rewrites_is_an_error(spark, make_tree):
    root = make_tree({"sub/a": b"1"})
    with pytest.raises(PySparkException, match="not a prefix"):
        listing.list_files(spark, f"{root}//sub").collect()


def test_flat_directory_of_100_000_entries_in_several_tasks(spark, tmp_path, monkeypatch):
    """Names are read by one task, entries looked at by many; no task holds more than a page of names."""
    root = tmp_path / "flat"
    (root / "deep").mkdir(parents=True)
    for number in range(100_000):
        os.close(os.open(root / f"{number}", os.O_CREAT | os.O_WRONLY))
    (root / "deep" / "last").write_text("x")
    entries = listing.scan_tree(spark, str(root), page_entries=4_000)
    files = entries.where("kind = 'file'")
    assert files.count() == 100_001
    assert files.select("uri").distinct().count() == 100_001
    assert entries.where("kind not in ('file', 'dir')").count() == 0
    assert {row["depth"] for row in files.select("depth").distinct().collect()} == {0, 1}
    # 26 pages, one or two to a task: their entries lie in files of as many tasks.
    sizes = [row["count"] for row in files.where("depth = 0").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 13 and max(sizes) <= 8_000
    flat = listing.list_files(spark, str(root), recursive=False, page_entries=4_000)
    assert flat.count() == 100_000


def test_page_sizes_list_the_same(spark, make_tree):
    root = make_tree({f"{folder}/{number}.txt": b"x" * number for folder in ("a", "a/b", "c") for number in range(7)})
    os.symlink(root, f"{root}/a/up")
    os.symlink(f"{root}/gone", f"{root}/a/dangling")
    rows = lambda page: sorted(map(tuple, listing.scan_tree(spark, root, page_entries=page).collect()))
    assert rows(1) == rows(3) == rows(7) == rows(1000)
    with pytest.raises(ValueError):
        listing.scan_tree(spark, root, page_entries=0)


def test_filters_and_projection(spark, make_tree):
    root = make_tree({"a": b"1"})
    files = listing.list_files(spark, f"{root}/")
    assert listing.emit_records(files).columns == ["fileName", "fullPath", "relativePath", "hostURI"]
    assert listing.drop_directories(files).count() == 1
    assert listing.drop_empty_paths(files).count() == 1
    assert listing.drop_empty_paths(files.selectExpr("'' AS relativePath")).count() == 0


def test_listing_happens_once(spark, make_tree):
    root = make_tree({"a": b"1"})
    files = listing.list_files(spark, root)
    os.remove(f"{root}/a")
    assert files.count() == 1 and files.count() == 1


def test_kinds_of_entries(spark, make_tree):
    """Directories are marked, links to directories are not followed, and what cannot be seen has a row."""
    root = make_tree({"a.txt": b"a", "sub/b.txt": b"b"})
    os.symlink(root, f"{root}/sub/up")
    os.symlink(f"{root}/gone", f"{root}/dangling")
    os.symlink(f"{root}/a.txt", f"{root}/copy.txt")
    entries = listing.scan_tree(spark, root + "/")
    kinds = {row["uri"].removeprefix(f"file:{root}/"): row["kind"] for row in entries.collect()}
    assert kinds == {
        "a.txt": "file", "copy.txt": "file", "sub": "dir", "sub/b.txt": "file", "sub/up": "link", "dangling": "broken",
    }
    described = listing.describe_files(entries)
    assert [row["fileName"] for row in described.where("isDir").collect()] == ["sub"]
    assert "sub" not in [row["fileName"] for row in listing.drop_directories(described).collect()]


def test_small_pages_share_tasks(spark, make_tree):
    root = make_tree({f"{number:03d}": b"x" for number in range(300)})
    entries = listing.scan_tree(spark, f"{root}/", page_entries=1)
    assert entries.count() == 300
    parts = {name.rsplit("/", 1)[1][:10] for name in entries.inputFiles() if "round=1" in name}
    assert 1 < len(parts) <= 5


def test_contents_of_listed_files(spark, make_tree):
    content = {f"{number % 4}/{number}": bytes([number]) * (number * 9) for number in range(140)} | {"big": b"b" * (17 << 20)}
    files = listing.list_files(spark, f"{make_tree(content)}/")
    read = chunks.read_contents(files.select("relativePath", "fullPath", "fileSize", "sourceURI"))
    assert {row.relativePath: bytes(row.content) for row in read.collect()} == content
