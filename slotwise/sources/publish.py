"""Published tables: whole versions, switched by one small manifest file.

A version is written to a folder of its own first.  Only when it is complete a manifest with the next
number is renamed into ``_manifests``; that rename is the switch.  Readers take the highest manifest,
so they see the old version until the switch and the new one from then on, never a part of one; a
job that dies before the switch leaves an unnamed folder behind and nothing else.  Renaming never
replaces a manifest: of two publishers with the same number one fails.  The folder's file system
must rename atomically (HDFS, local disks, most cloud file systems; not plain S3 listings).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Version:
    number: int
    tag: str                       # what the version stands for, as an as_of date or a batch number
    path: str
    schema: str                    # JSON of the rows' schema: an empty version is read alike


class PublishConflict(RuntimeError):
    """Another publisher has taken the next number."""


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _folder(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def versions(spark: SparkSession, root: str, name: str) -> list[Version]:
    """All published versions, oldest first."""
    fs, folder = _hadoop(spark, f"{_folder(root, name)}/_manifests")
    if not fs.exists(folder):
        return []
    found = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")]
    out = []
    for path in sorted(found, key=lambda p: p.getName()):
        stream = fs.open(path)
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        out.append(Version(**json.loads(text)))
    return out


def current(spark: SparkSession, root: str, name: str, before: str | None = None) -> Version | None:
    """The newest version; with ``before`` the newest whose tag is smaller."""
    known = [v for v in versions(spark, root, name) if before is None or v.tag < before]
    return known[-1] if known else None


def read(spark: SparkSession, version: Version) -> DataFrame:
    return spark.read.schema(T.StructType.fromJson(json.loads(version.schema))).parquet(version.path)


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    version = current(spark, root, name)
    if version is None:
        raise FileNotFoundError(f"nothing is published as {_folder(root, name)}")
    return read(spark, version)


def stage(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None) -> str:
    """Write the rows of a version nobody can see yet; return its folder."""
    path = f"{_folder(root, name)}/versions/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return path


def switch(spark: SparkSession, root: str, name: str, tag: str, path: str, schema: T.StructType, after: Version | None) -> Version:
    """Make a staged version the current one; fails if ``after`` isn't the current one any more."""
    version = Version((after.number if after else 0) + 1, tag, path, schema.json())
    fs, folder = _hadoop(spark, f"{_folder(root, name)}/_manifests")
    fs.mkdirs(folder)
    _, draft = _hadoop(spark, f"{_folder(root, name)}/_manifests/.{uuid.uuid4().hex}")
    _, final = _hadoop(spark, f"{_folder(root, name)}/_manifests/{version.number:012d}.json")
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(asdict(version)).encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(draft, final, options)
    except Exception as clash:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(clash):
            raise PublishConflict(f"version {version.number} of {_folder(root, name)} is there already") from clash
        raise
    return version


def publish(df: DataFrame, root: str, name: str, tag: str, partition_by: list[str] | None = None) -> Version:
    """Write ``df`` as the next version and switch to it.

    The version it follows is the one that was current when publishing began: what another publisher
    switches to meanwhile makes this call fail, and leaves the other's version current.
    """
    spark = df.sparkSession
    after = current(spark, root, name)
    return switch(spark, root, name, tag, stage(df, root, name, partition_by), df.schema, after)


def forget(spark: SparkSession, root: str, name: str, keep: int) -> int:
    """Delete all but the last ``keep`` versions' manifests and rows (at least one stays), and staged
    folders no manifest names if they aren't newer than the oldest kept version.  Returns how many
    folders went.  Readers of older versions must be done."""
    known = versions(spark, root, name)
    old, kept = known[:-max(keep, 1)], known[-max(keep, 1):]
    for v in old:
        fs, manifest = _hadoop(spark, f"{_folder(root, name)}/_manifests/{v.number:012d}.json")
        fs.delete(manifest, False)
    fs, folder = _hadoop(spark, f"{_folder(root, name)}/versions")
    if not kept or not fs.exists(folder):
        return 0
    names = {v.path.rstrip("/").rsplit("/", 1)[1] for v in kept}
    since = min(fs.getFileStatus(_hadoop(spark, v.path)[1]).getModificationTime() for v in kept)
    gone = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in names and s.getModificationTime() <= since]
    for path in gone:
        fs.delete(path, True)
    return len(gone)
