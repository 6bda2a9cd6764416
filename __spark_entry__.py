"""

The tables stand for what a file job sees: ``documents`` is a tree of files
``/corpus/<lang>/<source>/<doc_id>.txt``, either as a listing table or written
out to the shared folder once per session and scale.
"""

from __future__ import annotations

import hashlib
import io
import re
import uuid
import warnings
import zipfile
from collections.abc import Callable
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filehaul.functions import paths
from filehaul.functions.anonymize import anonymize
from filehaul.functions.crypto import generate_key_pair
from filehaul.functions.fields import compress_fields, decompress_fields
from filehaul.operators import digests, ordering, packing, transfer
from filehaul.options import DEFAULT_GROUP_FILES
from filehaul.plans.export import ENCRYPTED_TYPE, ExportResult, export_files
from filehaul.plans.restore import checksum_content, checksum_files, import_files, verify_files
from filehaul.sources import listing, splits
from filehaul.sources.chunks import read_contents, read_files
from filehaul.sources.records import text_records
from filehaul.storage import new_shared_dir, scratch_dir
from filehaul.streaming.batches import BatchStore, ingest_batches
from filehaul.streaming.ingest import check_query, ingest_stream

try:
    from filehaul.llm import queries as llm
except ImportError as missing:
    # Left out only where the subpackage, or a module of others that it needs, is not there.
    if (missing.name or "").startswith("filehaul") and missing.name not in ("filehaul.llm", "filehaul.llm.queries"):
        raise
    if missing.name not in ("filehaul.llm", "filehaul.llm.queries"):
        warnings.warn(f"the text queries are left out: {missing}")
    llm = None

RUN_TIME = datetime(2015, 1, 1, 20, 42)
SUFFIX = "yyyy-MM-dd-HH-mm"
ANONYMIZE_KEY = "a fixed key for the check"
FIELD_SPEC = "role:SNAPPY,text:GZIP"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
CSV_OPTIONS = {"timestampFormat": TIME_FORMAT, "timestampNTZFormat": TIME_FORMAT}
# Shares in which segmented_roundtrip goes through the documents, and the documents of a share below so many shares.
# A share is a part of the whole, so it grows with the documents and keeps a bigger cluster busy.
ROUNDTRIP_SHARES = 4
ROUNDTRIP_SHARE_FILES = 32_768

_trees: dict[tuple[str, str], str] = {}
_keys: dict[str, tuple[str, str]] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _document_paths(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    path = F.concat(
        F.lit("/corpus/"), "lang", F.lit("/"), "source", F.lit("/"), "doc_id", F.lit(".txt")
    )
    return documents.withColumn("path", path).select("path", *columns)


def _manifest(spark: SparkSession, sf_dir: str, root: str = "/corpus/") -> DataFrame:
    """Documents as a listing table."""
    entries = _document_paths(spark, sf_dir, "text").select(
        F.lit(root).alias("root"),
        F.concat(F.lit("hdfs://namenode:8020"), "path").alias("uri"),
        F.octet_length("text").cast("long").alias("fileSize"),
        F.lit(datetime(2024, 1, 1)).alias("modificationTime"),
    )
    return listing.describe_files(entries)


def _tree(spark: SparkSession, sf_dir: str) -> str:
    """Documents as a tree of files in the shared folder; URI of its root."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _trees:
        _trees[key] = _write_tree(spark, _document_paths(spark, sf_dir, "text"))
    return _trees[key]


def _write_tree(spark: SparkSession, documents: DataFrame) -> str:
    root, run_id = new_shared_dir(spark, "tree"), uuid.uuid4().hex
    transfer.write_contents(documents, root, run_id, "path", "text").write.parquet(
        new_shared_dir(spark, "tree-results")
    )
    transfer.delete_run_folder(root, run_id)
    return root


def _list(spark: SparkSession, roots: list[str], recursive: bool = True) -> DataFrame:
    """List directories given by URI; source paths carry no scheme."""
    scheme = "hdfs" if roots[0].startswith("hdfs:") else "file"
    plain = ["/" + re.sub("^[a-z]+:(//[^/]*)?", "", root).lstrip("/") for root in roots]
    return listing.list_files(spark, ",".join(plain), scheme, recursive)


def _scan(spark: SparkSession, root: str) -> DataFrame:
    return listing.scan_tree(spark, "/" + re.sub("^[a-z]+:(//[^/]*)?", "", root).lstrip("/"))


def _key_pair(spark: SparkSession) -> tuple[str, str]:
    application = spark.sparkContext.applicationId
    if application not in _keys:
        _keys[application] = generate_key_pair(spark)
    return _keys[application]


def _export(
    spark: SparkSession, sf_dir: str, compression: str, encryption: str
) -> tuple[str, ExportResult]:
    target = new_shared_dir(spark, "export")
    result = export_files(
        _list(spark, [f"{_tree(spark, sf_dir)}/corpus/"]),
        target,
        compression=compression,
        encryption=encryption,
        public_key=_key_pair(spark)[0],
        prefix="out",
        suffix=SUFFIX,
        run_time=RUN_TIME,
    )
    return target, result


def manifest_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.emit_records(_manifest(spark, sf_dir))


def host_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    host, path = paths.host_uri("url"), paths.full_path("url")
    return pages.select(
        "page_id", host.alias("hostURI"), path.alias("fullPath"),
        paths.source_uri(host, path).alias("sourceURI"),
    )


def list_real_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = _tree(spark, sf_dir)
    files = _list(spark, [f"{tree}/corpus", f"{tree}/missing"])
    return files.select("fileName", "relativePath", "hostURI", "fileSize", "isDir")


def multi_root_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = f"{_tree(spark, sf_dir)}/corpus"
    files = _list(spark, [f"{corpus}/en/", f"{corpus}/"])
    return files.select("fileName", "relativePath", "fileSize")


def non_recursive_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = f"{_tree(spark, sf_dir)}/corpus"
    listed = _list(spark, [f"{corpus}/en/src1/", f"{corpus}/"], recursive=False)
    derived = listing.direct_children(_manifest(spark, sf_dir), "/corpus/de/src2/")
    return listed.select("fileName", "fileSize").unionByName(derived.select("fileName", "fileSize"))


def empty_path_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _manifest(spark, sf_dir, "/")
    root = spark.range(1).select(
        F.lit("/").alias("root"), F.lit("hdfs://namenode:8020/").alias("uri"),
        F.lit(0).cast("long").alias("fileSize"), F.lit(None).cast("timestamp").alias("modificationTime"),
    )
    every = files.unionByName(listing.describe_files(root))
    return listing.drop_empty_paths(listing.drop_directories(every)).select(
        "fileName", "relativePath"
    )


def target_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _manifest(spark, sf_dir)
    modes = F.array(
        *(
            F.struct(F.lit(compress).alias("compress"), F.lit(encrypt).alias("encrypt"))
            for compress in (False, True)
            for encrypt in (False, True)
        )
    )
    target = F.concat(F.lit("gs://bucket-1/out/"), F.split_part("relativePath", F.lit("/"), F.lit(1)))
    listed = files.withColumn("target", target).select(
        "relativePath", "target", F.inline(modes)
    )
    prefix = paths.destination_prefix(paths.object_name("target"), RUN_TIME, SUFFIX)
    return listed.select(
        "relativePath",
        "compress",
        "encrypt",
        paths.bucket("target").alias("bucket"),
        paths.target_name(prefix, "relativePath", F.col("compress"), F.col("encrypt")).alias(
            "targetName"
        ),
        paths.content_type(F.col("compress"), F.col("encrypt")).alias("contentType"),
    )


def order_by_size_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.preview(ordering.by_size(_manifest(spark, sf_dir))).select(
        "fullPath", "fileSize"
    )


def order_by_path_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.preview(ordering.by_path(_manifest(spark, sf_dir))).select(
        "fullPath", "fileSize"
    )


def split_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.split_count(_manifest(spark, sf_dir))


def split_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _manifest(spark, sf_dir).select("fullPath", "fileSize")
    return ordering.by_bytes(packing.split_totals(packing.pack_files(files, group_files=None)))


def pack_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed in groups, as a listing too big for one task is; no split is heavier than the mean and one file."""
    files = _manifest(spark, sf_dir).select("fullPath", "fileSize")
    packed = packing.pack_files(files, max_split_size=16, group_files=256)
    biggest = F.max(F.col("biggest"))
    totals = packed.groupBy("split_id").agg(
        F.count("*").alias("files"), F.sum("fileSize").alias("total_bytes"), F.max("fileSize").alias("biggest")
    )
    return totals.agg(
        F.sum("files").alias("files"),
        F.sum("total_bytes").alias("bytes"),
        F.count("*").alias("splits"),
        (F.max("files") <= 16).alias("fits"),
        (F.max("total_bytes") <= F.avg("total_bytes") + biggest).alias("balanced"),
    )


def file_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole content as chunk rows, with small pieces so that most files have several."""
    files = _list(spark, [f"{_tree(spark, sf_dir)}/corpus/"])
    rows = read_files(files, chunk_bytes=1000, segment_bytes=10_000)
    return rows.groupBy("relativePath").agg(
        F.count("*").alias("chunks"),
        F.count_if("is_last").alias("segments"),
        F.sum(F.octet_length("data")).alias("bytes"),
    )


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, result = _export(spark, sf_dir, "NONE", "NONE")
    names = ("files", "source_bytes", "target_bytes", "failed_segments")
    row = tuple(result.metrics[name] for name in names)
    return spark.createDataFrame([row], ", ".join(f"{name} long" for name in names))


def plain_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, _ = _export(spark, sf_dir, "NONE", "NONE")
    copies = _list(spark, [f"{target}/out/"])
    return checksum_files(copies).select("relativePath", "bytes", "sha256")


def zip_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, _ = _export(spark, sf_dir, "ZIP", "NONE")
    target = new_shared_dir(spark, "import")
    import_files(spark, source, target)
    restored = _list(spark, [f"{target}/"])
    return checksum_files(restored).select("relativePath", "bytes", "sha256")


def encrypt_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, _ = _export(spark, sf_dir, "NONE", "PGP")
    target = new_shared_dir(spark, "import")
    restored = import_files(spark, source, target, private_keys=_key_pair(spark)[1])
    return restored.select("fileName", "relativePath", "bytes", "sha256", "status")


def zip_encrypt_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, result = _export(spark, sf_dir, "ZIP", "PGP")
    return result.manifest.select(
        "relativePath", "targetName", "contentType", "bytes", "sha256", "status"
    )


def encrypt_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, result = _export(spark, sf_dir, "NONE", "PGP")
    return result.manifest.select(
        "relativePath", "targetName", "contentType", "bytes", "sha256", "status"
    )


def verify_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, _ = _export(spark, sf_dir, "ZIP", "PGP")
    checked = verify_files(spark, source, private_keys=_key_pair(spark)[1])
    return checked.groupBy("status").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def checksum_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checksum_content(_table(spark, sf_dir, "pages"), "page_id", "html")


def field_compress_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = compress_fields(_table(spark, sf_dir, "conversations"), FIELD_SPEC)
    return decompress_fields(packed, FIELD_SPEC)


def _ingested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    folder = new_shared_dir(spark, "ingest")
    lines = F.to_csv(F.struct(*events.columns), CSV_OPTIONS)
    events.select(lines.alias("value")).write.text(f"{folder}/lines")
    ingest_stream(
        text_records(spark, f"{folder}/lines", max_files_per_trigger=4),
        events.schema,
        f"{folder}/checkpoint",
        path=f"{folder}/table",
        available_now=True,
        **CSV_OPTIONS,
    ).wait()
    return spark.read.schema(events.schema).parquet(f"{folder}/table")


def stream_csv_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested_events(spark, sf_dir)


def table_limit_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_query(_ingested_events(spark, sf_dir).orderBy("event_id"))


def _ingested_batches(spark: SparkSession, sf_dir: str) -> BatchStore:
    """Events as lines in eight files, a tenth with a wrong type and a tenth cut short, two files to a micro-batch."""
    events = _table(spark, sf_dir, "events")
    folder = new_shared_dir(spark, "batches")
    line = F.to_csv(F.struct(*events.columns), CSV_OPTIONS)
    wrong = F.to_csv(F.struct(F.lit("x").alias("event_id"), *events.columns[1:]), CSV_OPTIONS)
    line = F.when(F.col("event_id") % 10 == 3, wrong).when(F.col("event_id") % 10 == 7, F.col("event_id").cast("string")).otherwise(line)
    events.repartition(8).select(line.alias("value")).write.text(f"{folder}/lines")
    query, store = ingest_batches(
        text_records(spark, f"{folder}/lines", max_files_per_trigger=2), events.schema, f"{folder}/checkpoint", f"{folder}/store",
        available_now=True, **CSV_OPTIONS,
    )
    query.awaitTermination()
    return store


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected lines of one pass, and what they hold."""
    store = _ingested_batches(spark, sf_dir)
    number = lambda rows, kind, column: rows.agg(F.lit(kind).alias("kind"), F.count("*").alias("lines"), F.sum(column).alias("numbers"))
    short = store.rejected().select(F.when(~F.contains("line", F.lit(",")), F.col("line").cast("long")).alias("number"))
    return number(store.accepted(), "accepted", "event_id").unionByName(number(short, "rejected", "number"))


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The progress table of an ingest limited to two of eight files a batch: without the limit it were one batch."""
    progress = _ingested_batches(spark, sf_dir).progress()
    # Rows are dealt to files in turn by each task that writes them, so a file has its eighth but for a few.
    fits = F.max("input_rows") <= F.ceil(F.sum("input_rows") / 4) + 64
    return progress.agg(
        F.count("*").alias("batches"), F.sum("input_rows").alias("input_rows"), F.sum("accepted").alias("accepted"),
        F.sum("rejected").alias("rejected"), fits.alias("fits"), F.bool_and(F.col("started") <= F.col("ended")).alias("timed"),
    )


def incremental_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export the documents that have a label, then what an incremental run over all adds."""
    files = _list(spark, [f"{_tree(spark, sf_dir)}/corpus/"])
    labelled = _table(spark, sf_dir, "labels").select(
        F.concat("doc_id", F.lit(".txt")).alias("fileName")
    )
    target = new_shared_dir(spark, "export")
    export_files(files.join(labelled, "fileName", "left_semi"), target, suffix=SUFFIX, run_time=RUN_TIME)
    later = export_files(
        files, target, suffix=SUFFIX, run_time=RUN_TIME + timedelta(hours=1), mode="incremental"
    )
    return later.manifest.select(
        F.concat(F.lit("/corpus/"), "relativePath").alias("fullPath"), "fileSize"
    )


def sync_after_option_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An incremental run with compression after a plain one exports everything again."""
    files = _list(spark, [f"{_tree(spark, sf_dir)}/corpus/"])
    target = new_shared_dir(spark, "export")
    export_files(files, target, run_time=RUN_TIME)
    later = export_files(
        files, target, run_time=RUN_TIME + timedelta(hours=1), mode="incremental", compression="ZIP"
    )
    return later.manifest.select("relativePath", "targetName", "status")


def directory_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entries of the tree, and which of them the filter keeps."""
    entries = listing.describe_files(_scan(spark, f"{_tree(spark, sf_dir)}/corpus/"))
    kept = listing.drop_directories(entries).select("relativePath", F.lit(True).alias("kept"))
    dropped = entries.where("isDir").select("relativePath", F.lit(False).alias("kept"))
    return kept.unionByName(dropped)


def segmented_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export in segments of 10,000 bytes in all four modes, and restore.

    Every file takes whole blocks of the disk. A share of the documents is written out,
    exported, restored and read again at a time, and one mode's objects go before the next's are made.
    """
    documents = _document_paths(spark, sf_dir, "text")
    shares = max(1, min(ROUNDTRIP_SHARES, -(-documents.count() // ROUNDTRIP_SHARE_FILES)))
    restored = new_shared_dir(spark, "restored")
    schema = "compression string, encryption string, relativePath string, bytes long, sha256 string"
    with scratch_dir(spark, "roundtrip"):
        for share in range(shares):
            # By path: rows that name one file stay together.
            chosen = documents.where(F.pmod(F.xxhash64("path"), F.lit(shares)) == share)
            with scratch_dir(spark, "share"):
                files = _list(spark, [f"{_write_tree(spark, chosen)}/corpus/"])
                for compression in ("NONE", "ZIP"):
                    for encryption in ("NONE", "PGP"):
                        _restore_mode(spark, files, compression, encryption, restored)
    return spark.read.schema(schema).parquet(restored)


def _restore_mode(spark: SparkSession, files: DataFrame, compression: str, encryption: str, restored: str) -> None:
    """Add the checksums of files exported in one mode and restored to a table; only they stay."""
    public, private = _key_pair(spark)
    with scratch_dir(spark, "mode"):
        target = new_shared_dir(spark, "import")
        with scratch_dir(spark, "exported"):
            source = new_shared_dir(spark, "export")
            export_files(
                files, source, compression=compression, encryption=encryption, public_key=public,
                segment_bytes=10_000,
            )
            import_files(spark, source, target, private_keys=private)
        checksum_files(_list(spark, [f"{target}/"])).select(
            F.lit(compression).alias("compression"), F.lit(encryption).alias("encryption"),
            "relativePath", "bytes", "sha256",
        ).write.mode("append").parquet(restored)


def _objects(spark: SparkSession, target: str, ending: str) -> DataFrame:
    """Stored objects: name of the file they come from, and their bytes."""
    # Listed by tasks: Spark's file source would hold every object's status on the driver.
    found = _list(spark, [f"{target}/"])
    # As Spark's readers do, without what belongs to the store itself.
    hidden = F.col("relativePath").rlike("(^|/)[_.]")
    found = found.where(F.endswith("fileName", F.lit(ending)) & ~hidden).select("fileName", "fullPath", "fileSize", "sourceURI")
    name = F.regexp_extract("fileName", f"(?s)^(.+){re.escape(ending)}$", 1)
    return read_contents(found).select(name.alias("fileName"), "content")


def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written archives as the standard library reads them."""
    target, _ = _export(spark, sf_dir, "ZIP", "NONE")
    return _objects(spark, target, ".zip").mapInArrow(
        _read_archives, "fileName string, member string, bytes long, stored_plain string, sha256 string"
    )


def _shows(plain: bytes, stored: bytes) -> str:
    """Whether some piece of 64 bytes of the plain text, or all of a shorter one, stands in the stored bytes.

    Texts of a few letters may stand in anything by chance: they are 'short'.
    """
    if len(plain) < 16:
        return "short"
    starts = {*range(0, max(1, len(plain) - 63), 64), max(0, len(plain) - 64)}
    return "yes" if any(plain[start : start + 64] in stored for start in starts) else "no"


def _read_archives(batches):
    for batch in batches:
        rows = []
        for item in batch.to_pylist():
            with zipfile.ZipFile(io.BytesIO(item["content"])) as archive:
                for member in archive.infolist():
                    data = archive.read(member)
                    rows.append(
                        {
                            "fileName": item["fileName"], "member": member.filename, "bytes": len(data),
                            "stored_plain": _shows(data, item["content"]),
                            "sha256": hashlib.sha256(data).hexdigest(),
                        }
                    )
        yield pa.RecordBatch.from_pylist(
            rows,
            pa.schema(
                [("fileName", pa.string()), ("member", pa.string()), ("bytes", pa.int64()),
                 ("stored_plain", pa.string()), ("sha256", pa.string())]
            ),
        )


def encrypted_at_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a stored object shows its text, and whether it opens with the right key and with another."""
    target, _ = _export(spark, sf_dir, "NONE", "PGP")
    objects = _objects(spark, target, ".enc")
    plain = _document_paths(spark, sf_dir, "doc_id", "text").select(
        F.concat("doc_id", F.lit(".txt")).alias("fileName"), F.col("text").cast("binary").alias("plain")
    )

    def look(batches):
        for batch in batches:
            shown = [_shows(p, c) for p, c in zip(batch.column("plain").to_pylist(), batch.column("content").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("fileName"), pa.array(shown, pa.string())], names=["fileName", "shows_text"])

    shown = objects.join(plain, "fileName").mapInArrow(look, "fileName string, shows_text string")
    opened = verify_files(spark, target, private_keys=_key_pair(spark)[1])
    closed = verify_files(spark, target, private_keys=generate_key_pair(spark)[1])
    return (
        shown.join(opened.select("fileName", F.col("status").alias("with_key")), "fileName")
        .join(closed.select("fileName", F.col("status").alias("with_other_key")), "fileName")
    )


def source_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The splits as the data source gives them: files, bytes, and the partitions in which a split lies."""
    table = splits.read_splits(spark, splits.plan_splits(_manifest(spark, sf_dir)))
    placed = table.select("split_id", "fileSize", F.spark_partition_id().alias("part"))
    return placed.groupBy("split_id").agg(
        F.count("*").alias("files"), F.sum("fileSize").alias("total_bytes"), F.countDistinct("part").alias("partitions")
    )


def source_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Big files of one language, by filters that the source applies."""
    table = splits.read_splits(spark, splits.plan_splits(_manifest(spark, sf_dir), max_split_size=16))
    return table.where("fullPath like '/corpus/en/%' and fileSize >= 2000").select("fullPath", "fileSize")


def flat_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in one directory, looked at by pages of 100 entries."""
    root, run_id = new_shared_dir(spark, "flat"), uuid.uuid4().hex
    documents = _table(spark, sf_dir, "documents").select(F.concat("doc_id", F.lit(".txt")).alias("name"), "text")
    transfer.write_contents(documents, root, run_id, "name", "text").write.parquet(new_shared_dir(spark, "flat-results"))
    transfer.delete_run_folder(root, run_id)
    plain = "/" + re.sub("^[a-z]+:(//[^/]*)?", "", root).lstrip("/") + "/"
    files = listing.list_files(spark, plain, "hdfs" if root.startswith("hdfs:") else "file", page_entries=100)
    return files.select("relativePath", "fileSize")


def segmented_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree digests over blocks of 1,000 bytes, read in segments of 3,000 bytes and whole; only where both agree there is one."""
    files = _list(spark, [f"{_tree(spark, sf_dir)}/corpus/"])
    pieces = digests.file_digests(files, block_bytes=1000, segment_bytes=3000)
    whole = digests.file_digests(files, block_bytes=1000).select("relativePath", F.col("tree_sha256").alias("other"))
    same = F.when(F.col("tree_sha256") == F.col("other"), F.col("tree_sha256"))
    return pieces.join(whole, "relativePath").select("relativePath", "bytes", "blocks", same.alias("tree_sha256"))


def damaged_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that fail in a copy of the tree in which some files have another byte 1,500 and others end at byte 2,000."""
    documents = _document_paths(spark, sf_dir, "doc_id", "text").withColumn("data", F.col("text").cast("binary"))
    size = F.octet_length("data")
    flipped = F.concat(F.substring("data", 1, 1500), F.lit(b"\x00"), F.substring("data", 1502, 2**31 - 1))
    data = F.when((F.col("doc_id") % 7 == 3) & (size > 1500), flipped).when((F.col("doc_id") % 7 == 5) & (size > 2000), F.substring("data", 1, 2000))
    root, run_id = new_shared_dir(spark, "damaged"), uuid.uuid4().hex
    copies = documents.select("path", F.coalesce(data, F.col("data")).alias("data"))
    transfer.write_contents(copies, root, run_id, "path", "data").write.parquet(new_shared_dir(spark, "damaged-results"))
    transfer.delete_run_folder(root, run_id)
    expected = digests.block_digests(_list(spark, [f"{_tree(spark, sf_dir)}/corpus/"]), block_bytes=1000)
    found = digests.block_digests(_list(spark, [f"{root}/corpus/"]), block_bytes=1000)
    return digests.compare_blocks(expected, found, block_bytes=1000)


def anonymize_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {"c_name": "token", "c_custkey": "token", "c_mktsegment": "mask"}
    return anonymize(_table(spark, sf_dir, "customer"), spec, ANONYMIZE_KEY)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: list a tree, pack it, compress and encrypt every file, return the manifest."""
    return zip_encrypt_export(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All registered queries by name."""
    registered = [
        manifest_paths, host_uri, list_real_files, multi_root_scan, non_recursive_children,
        empty_path_filter, target_names, order_by_size_top, order_by_path_top, split_count,
        split_totals, pack_invariants, file_chunks, run_metrics, plain_copy, zip_roundtrip, encrypt_roundtrip,
        zip_encrypt_export, encrypt_export, verify_export, checksum_manifest,
        field_compress_roundtrip, stream_csv_to_table, table_limit_check, incremental_sync,
        anonymize_customer, sync_after_option_change, directory_filter, segmented_roundtrip,
        zip_members, encrypted_at_rest, source_partitions, source_filters, flat_directory,
        segmented_checksums, damaged_blocks, stream_rejects, stream_batches,
    ]
    return {query.__name__: query for query in registered} | (llm.queries() if llm else {})


_FILES = """
    SELECT doc_id, lang, source, text,
           CAST(doc_id AS VARCHAR) || '.txt' AS fileName,
           '/corpus/' || lang || '/' || source || '/' || doc_id || '.txt' AS fullPath,
           lang || '/' || source || '/' || doc_id || '.txt' AS relativePath,
           octet_length(encode(text)) AS fileSize
    FROM documents
"""

# The greedy packing, one file per step: the open split with the fewest bytes,
# and the lowest number among equals, takes the next biggest file.
_SPLIT_TOTALS = f"""
    WITH RECURSIVE files AS MATERIALIZED (
        SELECT fileSize, row_number() OVER (ORDER BY fileSize DESC, fullPath) AS place
        FROM ({_FILES})
    ),
    packing AS (
        SELECT CAST(0 AS BIGINT) AS place,
               list_transform(range((SELECT (count(*) + 127) // 128 FROM files)),
                              lambda number: {{'used': CAST(0 AS BIGINT), 'held': CAST(0 AS BIGINT),
                                          'number': number}}) AS splits
        UNION ALL
        SELECT files.place,
               list_transform(
                   splits,
                   lambda s: CASE WHEN s.number = chosen
                             THEN {{'used': s.used + fileSize, 'held': s.held + 1,
                                    'number': s.number}}
                             ELSE s END)
        FROM (SELECT place, splits,
                     list_min(list_transform(list_filter(splits, lambda s: s.held < 128),
                              lambda s: {{'used': s.used, 'number': s.number}})).number AS chosen
              FROM packing) AS step
        JOIN files ON files.place = step.place + 1
    )
    SELECT s.number AS split_id, s.held AS files, s.used AS total_bytes
    FROM (SELECT unnest(splits) AS s FROM packing
          WHERE place = (SELECT count(*) FROM files))
"""

# Splits of 128 files.
SPLIT_FILES = 128


def _split_totals_sql(group_files: int) -> str:
    """The packing rule: ranks dealt to groups forward and back, then in each group the emptiest split with room."""
    return f"""
    WITH RECURSIVE shape AS (
        SELECT total, greatest(1, (total + {group_files // SPLIT_FILES} - 1) // {group_files // SPLIT_FILES}) AS groups
        FROM (SELECT (count(*) + {SPLIT_FILES - 1}) // {SPLIT_FILES} AS total FROM ({_FILES}))
    ),
    ranked AS (
        SELECT fileSize, fullPath, row_number() OVER (ORDER BY fileSize DESC, fullPath) - 1 AS rank FROM ({_FILES})
    ),
    files AS MATERIALIZED (
        SELECT fileSize, grp, row_number() OVER (PARTITION BY grp ORDER BY fileSize DESC, fullPath) AS place
        FROM (SELECT fileSize, fullPath,
                     CASE WHEN (rank // total) % 2 = 0 THEN rank % total ELSE total - 1 - rank % total END % groups AS grp
              FROM ranked, shape)
    ),
    packing AS (
        SELECT grp, CAST(0 AS BIGINT) AS place,
               list_transform(range((total - grp + groups - 1) // groups),
                              lambda number: {{'used': CAST(0 AS BIGINT), 'held': CAST(0 AS BIGINT),
                                          'number': number}}) AS splits
        FROM shape, unnest(range(groups)) AS numbers(grp)
        UNION ALL
        SELECT files.grp, files.place,
               list_transform(
                   splits,
                   lambda s: CASE WHEN s.number = chosen
                             THEN {{'used': s.used + fileSize, 'held': s.held + 1,
                                    'number': s.number}}
                             ELSE s END)
        FROM (SELECT grp, place, splits,
                     list_min(list_transform(list_filter(splits, lambda s: s.held < {SPLIT_FILES}),
                              lambda s: {{'used': s.used, 'number': s.number}})).number AS chosen
              FROM packing) AS step
        JOIN files ON files.grp = step.grp AND files.place = step.place + 1
    )
    SELECT s.number * groups + grp AS split_id, s.held AS files, s.used AS total_bytes
    FROM (SELECT grp, unnest(splits) AS s FROM packing
          JOIN (SELECT grp, max(place) AS place FROM packing GROUP BY grp) USING (grp, place)), shape
"""


_OUT = "'out/2015-01-01-20-42/' || relativePath"


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the registered queries."""
    host = "regexp_extract(url, '^([a-z]+)://([^/:]+)', 1) || '://' || regexp_extract(url, '^([a-z]+)://([^/:]+)', 2) || '/'"
    # Paths are normal: single slashes, and none at the end.
    path = "regexp_extract(url, '^[a-z]+://[^/]*(.*)$', 1)"
    path = f"regexp_replace(regexp_replace({path}, '/+', '/', 'g'), '(.)/$', '\\1')"
    masked = "regexp_replace(regexp_replace(regexp_replace(c_mktsegment, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g')"
    # HMAC by its definition, with the padded key worked out here.
    pads = [bytes(byte ^ pad for byte in ANONYMIZE_KEY.encode().ljust(64, b"\0")).hex() for pad in (0x36, 0x5C)]
    token = f"sha256(unhex('{pads[1]}') || unhex(sha256(unhex('{pads[0]}') || encode({{}}))))"
    export = """SELECT relativePath, {name} AS targetName, '{type}' AS contentType,
                       fileSize AS bytes, sha256(text) AS sha256, 'ok' AS status FROM ({files})"""
    own = {
        "manifest_paths": f"""
            SELECT fileName, fullPath, relativePath, 'hdfs://namenode/' AS hostURI FROM ({_FILES})""",
        "host_uri": f"""
            SELECT page_id, {host} AS hostURI, {path} AS fullPath,
                   {host} || '/' || {path} AS sourceURI FROM pages""",
        "list_real_files": f"""
            SELECT fileName, 'corpus/' || relativePath AS relativePath, 'file:/' AS hostURI,
                   fileSize, false AS isDir FROM ({_FILES})""",
        "multi_root_scan": f"""
            SELECT fileName, source || '/' || fileName AS relativePath, fileSize
            FROM ({_FILES}) WHERE lang = 'en'
            UNION ALL SELECT fileName, relativePath, fileSize FROM ({_FILES})""",
        "non_recursive_children": f"""
            SELECT fileName, fileSize FROM ({_FILES})
            WHERE (lang = 'en' AND source = 'src1') OR (lang = 'de' AND source = 'src2')""",
        "empty_path_filter": f"""
            SELECT fileName, relativePath
            FROM (SELECT fileName, 'corpus/' || relativePath AS relativePath FROM ({_FILES})
                  UNION ALL SELECT '', '')
            WHERE relativePath <> ''""",
        "target_names": f"""
            SELECT relativePath, compress, encrypt, 'bucket-1' AS bucket,
                   'out/' || lang || '/2015-01-01-20-42/' || relativePath
                   || CASE WHEN compress THEN '.zip' ELSE '' END
                   || CASE WHEN encrypt THEN '.pgp' ELSE '' END AS targetName,
                   CASE WHEN encrypt THEN 'application/pgp-encrypted'
                        WHEN compress THEN 'application/zip'
                        ELSE 'application/octet-stream' END AS contentType
            FROM ({_FILES}),
                 (VALUES (false, false), (false, true), (true, false), (true, true))
                 AS modes(compress, encrypt)""",
        "order_by_size_top": f"""
            SELECT fullPath, fileSize FROM ({_FILES}) ORDER BY fileSize DESC, fullPath LIMIT 100""",
        "order_by_path_top": f"""
            SELECT fullPath, fileSize FROM ({_FILES}) ORDER BY fullPath LIMIT 100""",
        "split_count": """
            SELECT count(*) AS files, CAST(ceil(count(*) / 128.0) AS BIGINT) AS splits
            FROM documents""",
        "split_totals": _SPLIT_TOTALS,
        "pack_invariants": f"""
            SELECT count(*) AS files, CAST(sum(fileSize) AS BIGINT) AS bytes,
                   CAST(ceil(count(*) / 16.0) AS BIGINT) AS splits, true AS fits, true AS balanced FROM ({_FILES})""",
        "file_chunks": f"""
            SELECT relativePath,
                   CAST(CASE WHEN fileSize = 0 THEN 1
                             ELSE (fileSize // 10000) * 10 + ceil((fileSize % 10000) / 1000.0)
                        END AS BIGINT) AS chunks,
                   CAST(greatest(1, ceil(fileSize / 10000.0)) AS BIGINT) AS segments,
                   fileSize AS bytes FROM ({_FILES})""",
        "run_metrics": f"""
            SELECT count(*) AS files, CAST(sum(fileSize) AS BIGINT) AS source_bytes,
                   CAST(sum(fileSize) AS BIGINT) AS target_bytes,
                   CAST(0 AS BIGINT) AS failed_segments FROM ({_FILES})""",
        "plain_copy": f"""
            SELECT '2015-01-01-20-42/' || relativePath AS relativePath, fileSize AS bytes,
                   sha256(text) AS sha256 FROM ({_FILES})""",
        "zip_roundtrip": f"""
            SELECT relativePath, fileSize AS bytes, sha256(text) AS sha256 FROM ({_FILES})""",
        "encrypt_roundtrip": f"""
            SELECT fileName, relativePath, fileSize AS bytes, sha256(text) AS sha256,
                   'passed' AS status FROM ({_FILES})""",
        "zip_encrypt_export": export.format(name=f"{_OUT} || '.zip.enc'", files=_FILES, type=ENCRYPTED_TYPE),
        "encrypt_export": export.format(name=f"{_OUT} || '.enc'", files=_FILES, type=ENCRYPTED_TYPE),
        "verify_export": f"""
            SELECT 'passed' AS status, count(*) AS files, CAST(sum(fileSize) AS BIGINT) AS bytes
            FROM ({_FILES})""",
        "checksum_manifest": """
            SELECT page_id, octet_length(encode(html)) AS bytes, sha256(html) AS sha256 FROM pages""",
        "field_compress_roundtrip": "SELECT conv_id, turn, role, text FROM conversations",
        "stream_csv_to_table": """
            SELECT event_id, ts, user_id, event_type, value, props FROM events""",
        "table_limit_check": """
            SELECT event_id, ts, user_id, event_type, value, props FROM events
            ORDER BY event_id LIMIT 1000""",
        "incremental_sync": f"""
            SELECT fullPath, fileSize FROM ({_FILES}) AS files
            WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = files.doc_id)""",
        "anonymize_customer": f"""
            SELECT {token.format("CAST(c_custkey AS VARCHAR)")} AS c_custkey, {token.format("c_name")} AS c_name,
                   c_nationkey, c_acctbal, {masked} AS c_mktsegment FROM customer""",
        "sync_after_option_change": f"""
            SELECT relativePath, relativePath || '.zip' AS targetName, 'ok' AS status FROM ({_FILES})""",
        "directory_filter": f"""
            SELECT relativePath, true AS kept FROM ({_FILES})
            UNION ALL SELECT DISTINCT lang, false FROM documents
            UNION ALL SELECT DISTINCT lang || '/' || source, false FROM documents""",
        "segmented_roundtrip": f"""
            SELECT compression, encryption, relativePath, fileSize AS bytes, sha256(text) AS sha256
            FROM ({_FILES}), (VALUES ('NONE'), ('ZIP')) AS c(compression), (VALUES ('NONE'), ('PGP')) AS e(encryption)""",
        "zip_members": f"""
            SELECT fileName, fileName AS member, fileSize AS bytes, CASE WHEN fileSize >= 16 THEN 'no' ELSE 'short' END AS stored_plain,
                   sha256(text) AS sha256 FROM ({_FILES})""",
        "encrypted_at_rest": f"""
            SELECT fileName, CASE WHEN fileSize >= 16 THEN 'no' ELSE 'short' END AS shows_text, 'passed' AS with_key, 'error' AS with_other_key
            FROM ({_FILES})""",
        "stream_rejects": """
            SELECT 'accepted' AS kind, count(*) AS lines, CAST(sum(event_id) AS BIGINT) AS numbers FROM events WHERE event_id % 10 NOT IN (3, 7)
            UNION ALL
            SELECT 'rejected', count(*), CAST(sum(event_id) FILTER (event_id % 10 = 7) AS BIGINT) FROM events WHERE event_id % 10 IN (3, 7)""",
        "stream_batches": """
            SELECT CAST(4 AS BIGINT) AS batches, count(*) AS input_rows, count(*) FILTER (event_id % 10 NOT IN (3, 7)) AS accepted,
                   count(*) FILTER (event_id % 10 IN (3, 7)) AS rejected, true AS fits, true AS timed FROM events""",
        "source_partitions": f"SELECT split_id, files, total_bytes, CAST(1 AS BIGINT) AS partitions FROM ({_split_totals_sql(DEFAULT_GROUP_FILES)})",
        "source_filters": f"SELECT fullPath, fileSize FROM ({_FILES}) WHERE lang = 'en' AND fileSize >= 2000",
        "flat_directory": f"SELECT fileName AS relativePath, fileSize FROM ({_FILES})",
        "segmented_checksums": f"""
            WITH blocks AS (
                SELECT relativePath, fileSize, no, greatest(1, (fileSize + 999) // 1000) AS blocks,
                       sha256(unhex('00' || substr(hex(encode(text)), 2000 * no + 1, 2000))) AS digest
                FROM (SELECT *, unnest(range(greatest(1, (fileSize + 999) // 1000))) AS no FROM ({_FILES}))
            )
            SELECT relativePath, any_value(fileSize) AS bytes, any_value(blocks) AS blocks,
                   CASE WHEN count(*) = 1 THEN any_value(digest)
                        ELSE sha256(unhex('01' || string_agg(digest, '' ORDER BY no))) END AS tree_sha256
            FROM blocks GROUP BY relativePath""",
        "damaged_blocks": f"""
            SELECT relativePath, CAST(1 AS BIGINT) AS block_no, CAST(1000 AS BIGINT) AS "offset",
                   CAST(least(1000, fileSize - 1000) AS BIGINT) AS bytes, 'failed' AS status, 'differs' AS reason
            FROM ({_FILES}) WHERE doc_id % 7 = 3 AND fileSize > 1500
            UNION ALL
            SELECT relativePath, no, 1000 * no, CAST(least(1000, fileSize - 1000 * no) AS BIGINT), 'failed', 'missing'
            FROM (SELECT *, unnest(range(2, (fileSize + 999) // 1000)) AS no FROM ({_FILES}))
            WHERE doc_id % 7 = 5 AND fileSize > 2000""",
    }
    return own | (llm.oracle_sql() if llm else {})
