"""What operators need of the cluster: intermediate tables in the folder that all executors share, and this package on
every executor."""

from __future__ import annotations

import hashlib
import io
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import shared_folder

#: Applications that have the package.
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks can import it however the driver was
    started. It goes by way of the shared folder, written through Spark's own file system client."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package, packed = Path(__file__).resolve().parent.parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as files:
        for module in sorted(package.rglob("*.py")):
            files.writestr(zipfile.ZipInfo(str(module.relative_to(package.parent))), module.read_bytes())
    data = packed.getvalue()
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{package.name}-{hashlib.sha1(data).hexdigest()[:12]}.zip")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = store.create(path)
    out.write(bytearray(data))
    out.close()
    context.addPyFile(store.makeQualified(path).toString())
    _SHIPPED.add(context.applicationId)


def fresh(name: str, columns: list[str]) -> str:
    """``name``, with underscores after it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_rows(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``documents``, with their columns, that are not in ``found`` (doc_id, digest). A row is known again by
    its id and its text's digest, so that rows that share an id, or have none, are judged one by one."""
    found_id, found_digest, own = (fresh(n, documents.columns) for n in ("found_id", "found_digest", "own_digest"))
    found = found.select(F.col("doc_id").alias(found_id), F.col("digest").alias(found_digest)).distinct()
    digested = documents.withColumn(own, F.xxhash64(F.col("text").cast("string")))
    same = F.col("doc_id").eqNullSafe(F.col(found_id)) & (F.col(own) == F.col(found_digest))
    return digested.join(found, same, "left_anti").drop(own)


class Scratch:
    """Tables below one fresh folder. A stored table cuts the lineage: a lost executor reads files again. ``drop``
    removes a table that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        ship_package(spark)
        self.spark = spark
        self.root = shared_folder(spark)
        self.paths: dict[int, str] = {}
        self.count = 0

    def path(self) -> str:
        self.count += 1
        return f"{self.root}/{self.count}"

    def store(self, frame: DataFrame) -> DataFrame:
        path = self.path()
        frame.write.parquet(path)
        out = self.spark.read.schema(frame.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, frame: DataFrame) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(frame)))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
