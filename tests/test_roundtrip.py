"""What segmented_roundtrip keeps on disk while it runs and when it has ended."""

import hashlib
import os
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as registry
from filehaul.storage import delete_stored, exists, new_shared_dir, open_filesystem, scratch_dir, store_once

# Empty, of one segment, of exactly two, and of four.
TEXTS = ["", "a text of few words", "ä" * 10_000, "words and " * 3_500]


def stored_files(uris):
    """Sizes of the files below some folders, without those of tables."""
    roots = {open_filesystem(uri)[1] for uri in uris}
    found = (os.path.join(base, name) for root in roots for base, _, names in os.walk(root) for name in names)
    return [os.path.getsize(path) for path in found if path.endswith((".txt", ".zip", ".enc"))]


def test_objects_go_when_they_have_been_read(spark, tmp_path, monkeypatch):
    texts = {number: f"{TEXTS[number % 4]}{number or ''}" for number in range(48)}
    # A file that two rows name, and one without a text.
    rows = [(number, text) for number, text in texts.items()] + [(5, texts[5]), (99, None)]
    pq.write_table(
        pa.table({
            "doc_id": pa.array([row[0] for row in rows], pa.int64()), "text": pa.array([row[1] for row in rows], pa.string()),
            "lang": ["en"] * len(rows), "source": ["src1"] * len(rows),
        }),
        tmp_path / "documents.parquet",
    )
    monkeypatch.setattr(registry, "ROUNDTRIP_SHARE_FILES", 25, raising=False)
    made, held = set(), []

    def listed(spark, roots, *options):
        made.update(roots)
        return list_roots(spark, roots, *options)

    def exported(files, target, **options):
        made.add(target)
        return export(files, target, **options)

    def summed(files):
        held.append(sum(stored_files(made)))
        return checksums(files)

    list_roots, export, checksums = registry._list, registry.export_files, registry.checksum_files
    monkeypatch.setattr(registry, "_list", listed)
    monkeypatch.setattr(registry, "export_files", exported)
    monkeypatch.setattr(registry, "checksum_files", summed)
    found = registry.segmented_roundtrip(spark, str(tmp_path))
    rows = [tuple(row) for row in found.select("compression", "encryption", "relativePath", "bytes", "sha256").collect()]

    data = {f"en/src1/{number}.txt": text.encode() for number, text in texts.items()}
    assert Counter(rows) == Counter(
        (compression, encryption, path, len(content), hashlib.sha256(content).hexdigest())
        for compression in ("NONE", "ZIP") for encryption in ("NONE", "PGP") for path, content in data.items()
    )
    # A share lies there as the tree and as what was restored; with the exports of all shares it were nine times all files.
    assert max(held) < 2 * sum(map(len, data.values()))
    assert made and stored_files(made) == []


def test_scratch_folder_goes_with_what_it_holds(spark, tmp_path):
    kept = tmp_path / "kept"
    kept.write_bytes(b"kept")
    outside, _ = store_once(spark.range(3), "outside")
    with pytest.raises(OSError), scratch_dir(spark, "outer") as outer:
        first, _ = store_once(spark.range(3), "first")
        with scratch_dir(spark, "inner") as inner:
            second, _ = store_once(spark.range(3), "second")
            assert inner.startswith(outer) and second.stored_path.startswith(inner) and second.count() == 3
            shown = os.path.join(open_filesystem(inner)[1], "link")
            os.symlink(kept, shown)
        # Its bytes are given back at once, but not those of files that it only names.
        left = [path for base, _, names in os.walk(open_filesystem(inner)[1]) for path in (os.path.join(base, name) for name in names)]
        assert sum(os.path.getsize(path) for path in left if path != shown) == 0
        assert kept.read_bytes() == b"kept" and first.count() == 3
        raise OSError
    assert not exists(outer) and exists(outside.stored_path) and kept.read_bytes() == b"kept"
    assert not new_shared_dir(spark, "later").startswith(outer)
    delete_stored(outside)
