import hashlib
import random

import pytest

from filehaul.operators import digests
from filehaul.plans.restore import import_files, verify_files
from filehaul.plans.export import export_files
from filehaul.sources import listing

CONTENT = {"empty": b"", "one": b"x", "exact": b"ab" * 500, "over": b"c" * 1001, "long": random.Random(5).randbytes(26_543), "d/deep": b"deep" * 700}


def tree(content, block, fan):
    level = [hashlib.sha256(b"\x00" + content[at : at + block]).digest() for at in range(0, max(1, len(content)), block)]
    while len(level) > 1:
        groups = [level[at : at + fan] for at in range(0, len(level), fan)]
        level = [group[0] if len(group) == 1 else hashlib.sha256(b"\x01" + b"".join(group)).digest() for group in groups]
    return level[0].hex()


@pytest.mark.parametrize("segment, fan", [(1, 3), (2500, 2), (10_000, 1024), (1 << 20, 4)])
def test_against_a_plain_tree(spark, make_tree, segment, fan):
    files = listing.list_files(spark, make_tree(CONTENT) + "/")
    blocks = digests.block_digests(files, block_bytes=1000, segment_bytes=segment, task_bytes=3000)
    found = {row["relativePath"]: row for row in digests.tree_digests(blocks, fan).collect()}
    assert found.keys() == CONTENT.keys()
    for name, content in CONTENT.items():
        assert found[name]["tree_sha256"] == tree(content, 1000, fan)
        assert found[name]["bytes"] == len(content) and found[name]["blocks"] == max(1, -(-len(content) // 1000))


def test_grown_and_shrunk_files(spark, make_tree):
    root = make_tree({"a": b"1" * 2500, "b": b"2" * 2500})
    files = listing.list_files(spark, root + "/")
    with open(f"{root}/a", "ab") as target:
        target.write(b"3" * 5000)
    with open(f"{root}/b", "wb") as target:
        target.write(b"4" * 10)
    found = {row["relativePath"]: row["bytes"] for row in digests.file_digests(files, 1000, 1000).collect()}
    assert found == {"a": 7500, "b": 10}


def test_damage_is_located(spark, make_tree):
    whole = make_tree(CONTENT, "whole")
    hurt = dict(CONTENT, long=CONTENT["long"][:9_999] + b"!" + CONTENT["long"][10_000:], over=b"c" * 400, one=b"x" * 1500)
    del hurt["d/deep"]
    sides = [digests.block_digests(listing.list_files(spark, root + "/"), 1000) for root in (whole, make_tree(hurt, "hurt"))]
    rows = sorted((r["relativePath"], r["block_no"], r["offset"], r["bytes"], r["status"], r["reason"]) for r in digests.compare_blocks(*sides, 1000).collect())
    assert rows == [
        ("d/deep", 0, 0, 1000, "failed", "missing"), ("d/deep", 1, 1000, 1000, "failed", "missing"), ("d/deep", 2, 2000, 800, "failed", "missing"),
        ("long", 9, 9000, 1000, "failed", "differs"), ("one", 0, 0, 1, "failed", "differs"), ("one", 1, 1000, 500, "failed", "added"),
        ("over", 0, 0, 1000, "failed", "differs"), ("over", 1, 1000, 1, "failed", "missing"),
    ]
    assert digests.compare_blocks(sides[0], sides[0], 1000).count() == 0


def test_no_files_and_bad_options(spark, make_tree):
    files = listing.list_files(spark, make_tree({"a": b""})).limit(0)
    assert digests.file_digests(files).count() == 0
    with pytest.raises(ValueError):
        digests.block_digests(files, block_bytes=0)


def test_reports_hold_no_digest_of_digests_as_sha256(spark, make_tree, tmp_path):
    root, target = make_tree({"long": CONTENT["long"], "one": b"x"}), str(tmp_path / "out")
    export_files(listing.list_files(spark, root + "/"), target, segment_bytes=10_000)
    for report in (verify_files(spark, target), import_files(spark, target, str(tmp_path / "back"))):
        rows = {row["relativePath"]: row for row in report.collect()}
        assert rows["long"]["status"] == rows["one"]["status"] == "passed"
        assert rows["one"]["sha256"] == hashlib.sha256(b"x").hexdigest() and rows["long"]["sha256"] is None
        parts = [hashlib.sha256(CONTENT["long"][at : at + 10_000]).digest() for at in (0, 10_000, 20_000)]
        assert rows["long"]["parts_sha256"] == hashlib.sha256(b"".join(parts)).hexdigest()
