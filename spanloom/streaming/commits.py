"""What a micro-batch writes becomes visible at once: tables of files, and a manifest a batch that names them.

Each try of a batch writes to folders of its own; then one manifest names them all. Readers follow manifests, so a batch that
ends between its writes shows nothing, and one that is tried again, or run again after its manifest, shows once.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Digits of a batch's number in the name of its manifest.
WIDTH = 20


def _files(spark: SparkSession, path: str):
    """The file system that holds a path, and the path, as Hadoop has them."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def manifest(out: str, batch_id: int) -> str:
    return f"{out}/commits/{batch_id:0{WIDTH}d}.json"


def is_committed(spark: SparkSession, out: str, batch_id: int) -> bool:
    files, path = _files(spark, manifest(out, batch_id))
    return files.exists(path)


def stage(rows: DataFrame, out: str, kind: str, batch_id: int) -> str:
    """Write one table of a batch to a folder that nobody reads yet, and tell its name within ``out``."""
    name = f"data/{kind}/{batch_id}-{uuid.uuid4().hex}"
    rows.write.parquet(f"{out}/{name}")
    return name


def commit(spark: SparkSession, out: str, batch_id: int, folders: dict[str, str]) -> bool:
    """Publish a batch's folders, by kind, in one step: the manifest is written beside and renamed to its place. False if the batch
    is there already; what this try wrote then stays unread."""
    files, path = _files(spark, manifest(out, batch_id))
    _, draft = _files(spark, f"{out}/commits/.{uuid.uuid4().hex}")
    stream = files.create(draft, True)
    stream.write(bytearray(json.dumps({"batch": batch_id, "folders": folders}), "utf-8"))
    stream.close()
    if not files.exists(path) and files.rename(draft, path):
        return True
    files.delete(draft, False)
    return False


def committed(spark: SparkSession, out: str, kind: str, before: int | None = None) -> list[str]:
    """Folders of a kind that manifests name, in the order of batches (those below ``before`` only)."""
    files, folder = _files(spark, f"{out}/commits")
    if not files.exists(folder):
        return []
    names = sorted(s.getPath().getName() for s in files.listStatus(folder) if s.getPath().getName().endswith(".json"))
    names = [n for n in names if before is None or int(n.removesuffix(".json")) < before]
    if not names:
        return []
    rows = spark.read.schema("batch long, folders map<string,string>").json([f"{out}/commits/{n}" for n in names])
    return [f"{out}/{r.folder}" for r in rows.selectExpr("batch", f"folders['{kind}'] AS folder").where("folder is not null").orderBy("batch").collect()]  # a name a batch


def read_committed(spark: SparkSession, out: str, kind: str, before: int | None = None) -> DataFrame | None:
    """A table as committed batches have it; None before the first."""
    folders = committed(spark, out, kind, before)
    return spark.read.parquet(*folders) if folders else None
