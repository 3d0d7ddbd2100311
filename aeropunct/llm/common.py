"""What the operators of this subpackage share: inputs, intermediate tables, seeds."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeropunct.session import remove, scratch_dir

# A word is a maximal run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Lets Spark hand this package to its Python workers, once an application.

    A registered query may run in a session whose workers do not have it on their
    path; the archive goes through Spark's own file distribution.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        name = f"{tempfile.mkdtemp(prefix='ship-')}/{package.name}"
        archive = shutil.make_archive(name, "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


class Scratch:
    """Intermediate tables of one job, in the shared folder the cluster names.

    A written table cuts the lineage: a lost executor costs the tasks of the
    current step only. Tables that a returned DataFrame reads stay until whoever
    runs the job clears the folder.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_dir(spark, label)
        self.count = 0
        self.kept: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count:03d}-{name}"

    def keep(self, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
        """The table written and read back."""
        path = self.path(name)
        df.write.option("compression", codec).parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.kept[path] = kept
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Removes tables that no later step reads."""
        for path in [p for p, df in self.kept.items() if any(df is t for t in tables)]:
            del self.kept[path]
            remove(self.spark, path)

    def drop_all_but(self, *tables: DataFrame) -> None:
        self.drop(*[df for df in self.kept.values() if not any(df is t for t in tables)])


def uniform(*keys: Column) -> Column:
    """A number in (0, 1) that depends on the keys only, so that reruns agree."""
    bits = F.shiftrightunsigned(F.xxhash64(*keys), 11).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(2**53))


def in_training(doc_id: Column) -> Column:
    """Rows whose labels may be learnt from: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def held_out(doc_id: Column) -> Column:
    """The other rows; a null id is never learnt from, so it counts as held out."""
    return ~F.coalesce(in_training(doc_id), F.lit(False))
