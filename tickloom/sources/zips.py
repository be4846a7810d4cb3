"""Zip archives as a Spark data source, planned by the sizes of their members.

``spark.read.format("zip_lines").load(path)`` gives ``(archive, member, line_no, line)`` for every text member below
``path`` whose name stays inside the archive's directory. Planning reads the archives' directories only, several at a time:
members are listed with their unpacked sizes and cut into partitions of about ``partitionBytes`` of text. A member cannot
be entered in its middle, so a large one is a partition of its own and the small ones around it share others. Members are
streamed in bounded batches. Bytes that are not in ``encoding`` are an error.
"""

import io
import zipfile
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tickloom.sources.text import safe_member

SCHEMA = "archive string, member string, line_no long, line string"
PARTITION_BYTES = 64 << 20
MEMBER_BYTES = 1 << 16  # opening a member costs about as much as reading this many bytes
BATCH_CHARS = 4_000_000
LISTING_THREADS = 16


def file_system(uri: str):
    """``(file system, path)`` of a URI on whichever shared file system it lies."""
    import re

    from pyarrow import fs

    uri = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/(?!/)", "file:///", uri))
    return fs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")


def archives_below(path: str) -> list:
    """Paths of the zip files at or below ``path``, in order; hidden ones are left out."""
    from pyarrow import fs

    system, base = file_system(path)
    info = system.get_file_info(base)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(base, recursive=True))
    return sorted(f.path for f in found if f.is_file and f.extension == "zip" and f.base_name[0] not in "._")


def members_of(system, archive: str) -> list:
    """``(archive, member, unpacked bytes)`` from the archive's directory."""
    with system.open_input_file(archive) as f, zipfile.ZipFile(f) as z:
        return [(archive, i.filename, i.file_size) for i in z.infolist() if not i.is_dir() and safe_member(i.filename)]


def deal(members: list, target: int) -> list:
    """Runs of ``members`` of about ``target`` bytes: a run ends before the member that would fill it beyond the target."""
    out, held = [], 0
    for member in members:
        weight = member[2] + MEMBER_BYTES
        if not out or held + weight > target:
            out.append([])
            held = 0
        out[-1].append(member)
        held += weight
    return out


class Members(InputPartition):
    def __init__(self, members: list):
        self.members = members


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.encoding = options["path"], options.get("encoding", "utf-8")
        self.bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tasks = int(options.get("tasks", 1))

    def partitions(self):
        system, _ = file_system(self.path)
        with ThreadPoolExecutor(LISTING_THREADS) as pool:
            members = [m for found in pool.map(lambda a: members_of(system, a), archives_below(self.path)) for m in found]
        total = sum(size + MEMBER_BYTES for _, _, size in members)
        runs = deal(members, max(1, min(self.bytes, total // self.tasks)))
        return [Members(run) for run in runs] or [Members([])]

    def read(self, partition):
        system, _ = file_system(self.path)
        for archive, members in _by_archive(partition.members):
            with system.open_input_file(archive) as f, zipfile.ZipFile(f) as z:
                for member in members:
                    with z.open(member) as raw:
                        yield from _batches(archive, member, io.TextIOWrapper(raw, encoding=self.encoding))


def _by_archive(members: list):
    at = 0
    while at < len(members):
        upto = next((k for k in range(at, len(members)) if members[k][0] != members[at][0]), len(members))
        yield members[at][0], [m for _, m, _ in members[at:upto]]
        at = upto


def _batches(archive: str, member: str, text):
    def batch():
        n = len(held)
        return pa.RecordBatch.from_arrays([pa.array([archive] * n, pa.string()), pa.array([member] * n, pa.string()),
                                           pa.array(range(first, first + n), pa.int64()), pa.array(held, pa.string())],
                                          names=["archive", "member", "line_no", "line"])

    first, held, size = 0, [], 0
    for line in text:
        held.append(line.rstrip("\r\n"))
        size += len(line)
        if size > BATCH_CHARS:
            yield batch()
            first, held, size = first + len(held), [], 0
    if held:
        yield batch()


class ZipLines(DataSource):
    @classmethod
    def name(cls):
        return "zip_lines"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def scan_zip_members(spark: SparkSession, path: str, encoding: str = "utf-8", partition_bytes: int = PARTITION_BYTES):
    """Lines of the text members of all zip archives at or below ``path``: ``(archive, member, line_no, line)``."""
    spark.dataSource.register(ZipLines)
    return (spark.read.format("zip_lines").option("encoding", encoding).option("partitionBytes", str(partition_bytes))
            .option("tasks", str(spark.sparkContext.defaultParallelism)).load(path))
