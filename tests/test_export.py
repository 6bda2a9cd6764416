import hashlib
import os
import zipfile
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from filehaul.operators import packing, transfer
from filehaul.options import ExportOptions
from filehaul.plans.export import (
    _planned_segments,
    export_files,
    export_tree,
    read_manifest,
    transfer_rows,
)
from filehaul.functions.crypto import generate_key_pair
from filehaul.plans.restore import checksum_files, import_files, verify_files
from filehaul.sources import chunks, listing

CHUNK = 1000
CONTENT = {
    "empty": b"",
    "one byte": b"\xff",
    "exact": b"e" * CHUNK,
    "more": b"m" * (CHUNK + 1),
    "d/binary.bin": bytes(range(256)) * 41,
    "d/text.txt": b"some text, again and again. " * 300,
}
ENDINGS = {
    ("NONE", "NONE"): ("", "application/octet-stream"),
    ("ZIP", "NONE"): (".zip", "application/zip"),
    ("NONE", "PGP"): (".enc", "application/vnd.filehaul.encrypted"),
    ("ZIP", "PGP"): (".zip.enc", "application/vnd.filehaul.encrypted"),
}


def parts_digest(content, segment_bytes):
    pieces = [content[start : start + segment_bytes] for start in range(0, len(content), segment_bytes)] or [b""]
    return hashlib.sha256(b"".join(hashlib.sha256(piece).digest() for piece in pieces)).hexdigest()


@pytest.mark.parametrize("segment_bytes", [1 << 30, 2500])
@pytest.mark.parametrize("compression, encryption", ENDINGS)
def test_all_modes_and_back(
    spark, keys, make_tree, tmp_path, compression, encryption, segment_bytes
):
    root, target, back = make_tree(CONTENT), str(tmp_path / "target"), str(tmp_path / "back")
    result = export_tree(
        spark, f"{root}/", target, compression=compression, encryption=encryption,
        public_key=keys[0], prefix="out", chunk_bytes=CHUNK, segment_bytes=segment_bytes,
        max_split_size=3,
    )
    ending, kind = ENDINGS[compression, encryption]
    rows = {row["relativePath"]: row for row in result.manifest.collect()}
    assert set(rows) == set(CONTENT)
    for path, content in CONTENT.items():
        row, written = rows[path], f"{target}/out/{path}{ending}"
        assert row["targetName"] == f"out/{path}{ending}" and row["contentType"] == kind
        assert row["bytes"] == len(content) and row["status"] == "ok"
        # The digest of the content or nothing, whatever the size.
        whole = len(content) <= segment_bytes
        assert row["sha256"] == (hashlib.sha256(content).hexdigest() if whole else None)
        assert row["parts_sha256"] == parts_digest(content, segment_bytes)
        stored = open(written, "rb").read()
        if (compression, encryption) == ("NONE", "NONE"):
            assert stored == content
        elif encryption == "NONE":
            with zipfile.ZipFile(written) as archive:
                assert archive.testzip() is None
                assert archive.namelist() == [os.path.basename(path)]
                assert archive.read(os.path.basename(path)) == content
        elif len(content) > 1:
            assert content[:50] not in stored
    assert result.metrics["files"] == len(CONTENT)
    assert result.metrics["source_bytes"] == sum(map(len, CONTENT.values()))
    assert result.metrics["failed_segments"] == 0

    checked = verify_files(spark, target, private_keys=keys[1]).collect()
    assert sorted(row["status"] for row in checked) == ["passed"] * len(CONTENT)
    restored = import_files(spark, target, back, private_keys=[keys[1]], chunk_bytes=CHUNK)
    assert {row["relativePath"]: row["status"] for row in restored.collect()} == dict.fromkeys(
        CONTENT, "passed"
    )
    for path, content in CONTENT.items():
        assert open(f"{back}/{path}", "rb").read() == content
    for folder in (target, back):
        assert not [name for name in os.listdir(folder) if name.startswith("_run-")]


def test_content_does_not_cross_a_shuffle(spark, keys, make_tree, tmp_path):
    files = listing.list_files(spark, make_tree(CONTENT))
    work = files.withColumns({"targetName": F.col("relativePath"), "logicalName": F.col("relativePath")})
    options = ExportOptions(encryption="PGP", public_key=keys[0]).checked(spark)
    _, segments = _planned_segments(work, options)
    rows = transfer_rows(segments, str(tmp_path / "target"), "run", options)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    above_shuffle = plan[: plan.index("Exchange")]
    assert above_shuffle.count("MapInArrow") == 2
    assert "aes_encrypt" not in plan[plan.index("Exchange") :]
    assert "GCM" in above_shuffle


def test_chunk_rows(spark, make_tree):
    files = listing.list_files(spark, make_tree(CONTENT) + "/")
    rows = chunks.read_files(files.drop("sourceURI"), CHUNK, 2500).collect()
    for path, content in CONTENT.items():
        own = sorted(
            (row["seg_no"], row["chunk_no"], row["is_last"], bytes(row["data"]))
            for row in rows
            if row["relativePath"] == path
        )
        assert b"".join(row[3] for row in own) == content
        assert max(len(row[3]) for row in own) <= CHUNK
        assert sum(row[2] for row in own) == max(1, -(-len(content) // 2500))


def test_checksums(spark, make_tree):
    files = listing.list_files(spark, make_tree(CONTENT) + "/")
    rows = checksum_files(files, CHUNK).collect()
    assert {row["relativePath"]: row["sha256"] for row in rows} == {
        path: hashlib.sha256(content).hexdigest() for path, content in CONTENT.items()
    }


def test_suffix_and_compat_names(spark, make_tree, tmp_path):
    root = make_tree({"a": b"1"})
    for number, (options, name) in enumerate([
        ({"prefix": "out", "suffix": "yyyy"}, "out/2015/source/a"),
        ({"prefix": "out", "compat": True}, "outsource/a"),
        ({}, "source/a"),
    ]):
        result = export_tree(
            spark, root, str(tmp_path / f"t{number}"), run_time=datetime(2015, 6, 1), **options
        )
        assert result.manifest.first()["targetName"] == name


def test_incremental_runs(spark, make_tree, tmp_path):
    root, target = make_tree({"a": b"1", "b": b"2"}), str(tmp_path / "target")
    times = [datetime(2024, 1, day, tzinfo=timezone.utc) for day in range(1, 6)]

    def run(day, mode="incremental"):
        result = export_tree(spark, f"{root}/", target, mode=mode, run_time=times[day])
        return sorted(row["relativePath"] for row in result.manifest.collect())

    assert run(0) == ["a", "b"]
    assert run(1) == []
    with open(f"{root}/b", "wb") as changed:
        changed.write(b"22")
    with open(f"{root}/c", "wb") as added:
        added.write(b"3")
    assert run(2) == ["b", "c"]
    os.utime(f"{root}/a", (1, 1))
    assert run(3) == ["a"]
    assert run(4, mode="full") == ["a", "b", "c"]
    assert read_manifest(spark, f"{target}/_manifest").count() == 8
    import_files(spark, target, str(tmp_path / "back"))
    assert (tmp_path / "back" / "b").read_bytes() == b"22"
    with pytest.raises(ValueError):
        run(0, mode="sometimes")


def test_vanished_file(spark, make_tree, tmp_path):
    root = make_tree({"a": b"1", "b": b"2"})
    files = listing.list_files(spark, f"{root}/")
    os.remove(f"{root}/a")
    with pytest.raises(Exception, match="FileNotFound|No such file"):
        export_files(files, str(tmp_path / "strict"))
    assert not os.path.exists(tmp_path / "strict" / "_manifest")
    result = export_files(files, str(tmp_path / "lenient"), on_error="record")
    rows = {row["relativePath"]: row for row in result.manifest.collect()}
    assert rows["b"]["status"] == "ok"
    assert rows["a"]["status"] == "error" and "FileNotFoundError" in rows["a"]["error"]
    assert not os.path.exists(tmp_path / "lenient" / "a")


def test_write_error_is_recorded(spark, make_tree, tmp_path):
    files = listing.list_files(spark, make_tree({"a": b"1", "b": b"22" * 3000}) + "/")
    target = tmp_path / "target"
    (target / "b").mkdir(parents=True)
    for segment_bytes in (None, 2500):
        result = export_files(files, str(target), on_error="record", segment_bytes=segment_bytes)
        assert {row["relativePath"]: row["status"] for row in result.manifest.collect()} == {
            "a": "ok", "b": "error"}


def test_overwrite_and_repeated_roots(spark, make_tree, tmp_path):
    root, target = make_tree({"a": b"new"}), tmp_path / "target"
    target.mkdir()
    (target / "a").write_bytes(b"something older")
    result = export_tree(spark, f"{root}/,{root}/", str(target))
    assert result.manifest.count() == 1
    assert (target / "a").read_bytes() == b"new"


def test_colliding_names_are_an_error(spark, make_tree, tmp_path):
    first, second = make_tree({"a": b"1"}, "first"), make_tree({"a": b"2"}, "second")
    with pytest.raises(ValueError, match="target names"):
        export_tree(spark, f"{first}/,{second}/", str(tmp_path / "target"))


def test_nothing_to_export(spark, tmp_path):
    result = export_tree(spark, f"{tmp_path}/missing", str(tmp_path / "target"))
    assert result.manifest.count() == 0 and result.metrics["files"] == 0
    assert import_files(spark, str(tmp_path / "target"), str(tmp_path / "back")).count() == 0


def test_table_content_to_objects(spark, tmp_path):
    table = spark.createDataFrame([("x/a.txt", "text"), ("b", "")], "name string, body string")
    rows = transfer.write_contents(table, str(tmp_path), "run", "name", "body").collect()
    transfer.delete_run_folder(str(tmp_path), "run")
    assert {row["targetName"]: row["sha256"] for row in rows} == {
        "x/a.txt": hashlib.sha256(b"text").hexdigest(), "b": hashlib.sha256(b"").hexdigest()}
    assert (tmp_path / "x" / "a.txt").read_bytes() == b"text"
    assert sorted(os.listdir(tmp_path)) == ["b", "x"]


def test_repeated_tasks(spark, keys, make_tree, tmp_path):
    """Every task dies once, after it has written objects; the repeat gives the same result."""
    from pyspark import TaskContext

    contents = {f"d{number % 3}/{number}": bytes([number]) * 3000 for number in range(40)}
    files = listing.list_files(spark, make_tree(contents) + "/")
    name = F.concat(F.col("relativePath"), F.lit(".enc"))
    work = files.withColumns({"targetName": name, "logicalName": name})
    options = ExportOptions(
        encryption="PGP", public_key=keys[0], max_split_size=10, chunk_bytes=CHUNK
    ).checked(spark)
    _, segments = _planned_segments(work, options)

    def dies_once(batches):
        for batch in batches:
            yield batch
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")

    target = str(tmp_path / "target")
    dying = transfer_rows(segments, target, "run", options).mapInArrow(
        dies_once, transfer_rows(segments, target, "run", options).schema
    )
    rows = dying.collect()
    assert sorted(row["relativePath"] for row in rows) == sorted(contents)
    transfer.delete_run_folder(target, "run")
    names = [os.path.relpath(os.path.join(folder, name), target)
             for folder, _, found in os.walk(target) for name in found]
    assert sorted(names) == sorted(f"{path}.enc" for path in contents)
    assert all(os.path.getsize(f"{target}/{row['targetName']}") == row["target_bytes"] for row in rows)


def test_same_path_on_two_hosts_is_an_error(spark, make_tree, tmp_path):
    files = listing.list_files(spark, make_tree({"a": b"1"}) + "/")
    other = files.withColumn("sourceURI", F.concat(F.lit("hdfs://other"), "fullPath"))
    with pytest.raises(ValueError, match="target names"):
        export_files(files.unionByName(other), str(tmp_path / "target"))


def exported_again(spark, files, target, **options):
    result = export_files(files, target, mode="incremental", **options)
    return {row["relativePath"] for row in result.manifest.collect()}


def test_incremental_after_a_change_of_options(spark, keys, make_tree, tmp_path):
    files, target = listing.list_files(spark, make_tree({"a": b"1", "b": b"2"}) + "/"), str(tmp_path / "target")
    export_files(files, target, suffix="yyyy", run_time=datetime(2015, 1, 1))
    # Another date alone is no change.
    assert exported_again(spark, files, target, suffix="yyyy", run_time=datetime(2016, 1, 1)) == set()
    sealed = {"encryption": "PGP", "public_key": keys[0]}
    assert exported_again(spark, files, target, suffix="yyyy", **sealed) == {"a", "b"}
    assert exported_again(spark, files, target, suffix="yyyy", **sealed) == set()
    assert exported_again(spark, files, target, prefix="other") == {"a", "b"}
    other = {"encryption": "PGP", "public_key": generate_key_pair(spark)[0]}
    assert exported_again(spark, files, target, suffix="yyyy", **other) == {"a", "b"}


def test_incremental_after_an_object_was_deleted(spark, make_tree, tmp_path):
    files, target = listing.list_files(spark, make_tree({"a": b"1", "b": b"2"}) + "/"), tmp_path / "target"
    export_files(files, str(target))
    (target / "a").unlink()
    assert exported_again(spark, files, str(target)) == {"a"}
    assert (target / "a").read_bytes() == b"1"


def test_intermediate_tables_go(spark, make_tree, tmp_path, monkeypatch):
    from filehaul import storage

    files = listing.list_files(spark, make_tree({"a": b"1" * 5000}) + "/")
    made = []

    def new_shared_dir(spark, purpose):
        made.append(f"{tmp_path}/shared/{purpose}-{len(made)}")
        return f"file:{made[-1]}"

    monkeypatch.setattr(storage, "new_shared_dir", new_shared_dir)
    export_files(files, str(tmp_path / "target"), segment_bytes=2000)
    assert made and not any(map(os.path.exists, made))


def test_cut_files_share_join_tasks(spark, make_tree, tmp_path, monkeypatch):
    """Many small files of several segments are joined by some tasks, not by one for each file."""
    content = {f"{number % 3}/{number}": bytes([number]) * (15 + number) for number in range(60)}
    source, target = make_tree(content), str(tmp_path / "target")
    tasks, placed = [], packing.one_task_per_split
    monkeypatch.setattr(packing, "one_task_per_split", lambda packed, splits, *rest: tasks.append(min(splits, *rest or [splits])) or placed(packed, splits, *rest))
    result = export_tree(spark, f"{source}/", target, segment_bytes=10, compression="ZIP")
    assert len(tasks) == 2 and max(tasks) <= 4 * spark.sparkContext.defaultParallelism
    assert result.metrics["parts"] > 120
    for name, data in content.items():
        with zipfile.ZipFile(f"{target}/{name}.zip") as archive:
            assert archive.read(archive.namelist()[0]) == data
