"""Typed tables in buckets of one key, so that jobs on that key shuffle nothing.

The latest event per order and the joins of the timeline all group by ``order_id``.
Tables that lie in buckets of it, sorted, are read bucket by bucket: neither the aggregates nor the joins need
an exchange.  A table is replaced by writing a new version beside the old one and moving its name, so
a reader sees one of them whole.  Where one bucket is far larger than the others (a hot key), the table is read as
plain files instead: its bucket would be one task, plain files are split, and the exchange deals with skew.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import delete_folders

BUCKET_OF_FILE = re.compile(r"_(\d{5})(?:\.|$)")


@dataclass
class BucketedTables:
    """``root``: a folder that every executor can reach; ``hot``: a bucket of more than ``hot`` times the mean size, and more
    than ``hot_bytes``, is not read as one task."""

    spark: SparkSession
    root: str
    key: str = "order_id"
    buckets: int = 64
    hot: float = 8.0
    hot_bytes: int = 256 << 20
    versions: dict[str, str] = field(default_factory=dict)

    def write(self, df: DataFrame, name: str) -> None:
        version = f"{name}_{uuid.uuid4().hex}"
        (df.repartition(self.buckets, self.key)  # a task writes whole buckets: one file each
         .write.bucketBy(self.buckets, self.key).sortBy(self.key).option("path", f"{self.root}/{version}").saveAsTable(version))
        before = self.versions.get(name)
        self.versions[name] = version
        if before:
            self.spark.sql(f"DROP TABLE {before}")
            delete_folders(self.spark, [f"{self.root}/{before}"])

    def bucket_bytes(self, name: str) -> dict[int, int]:
        """Size of each bucket, from the names of the files."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{self.versions[name]}")
        out: dict[int, int] = defaultdict(int)
        for f in folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(folder):
            found = BUCKET_OF_FILE.search(f.getPath().getName())
            if found:
                out[int(found[1])] += f.getLen()
        return dict(out)

    def read(self, name: str) -> DataFrame:
        sizes = self.bucket_bytes(name)
        largest = max(sizes.values(), default=0)
        if largest > self.hot_bytes and largest * self.buckets > self.hot * sum(sizes.values()):
            table = self.spark.table(self.versions[name])
            return self.spark.read.schema(table.schema).parquet(f"{self.root}/{self.versions[name]}")
        return self.spark.table(self.versions[name])

    def drop(self) -> None:
        for version in self.versions.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {version}")
            delete_folders(self.spark, [f"{self.root}/{version}"])
        self.versions.clear()
