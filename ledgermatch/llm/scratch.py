"""Tables that must outlive an executor, in the folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.session import ensure_checkpoint_dir


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of files, not a re-run.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application.

    Does what ``--py-files`` does for sessions that were started without it.
    """
    sc = spark.sparkContext
    if getattr(sc, "_ledgermatch_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="package-")) / "ledgermatch.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._ledgermatch_shipped = True


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(*cols: Column) -> Column:
    """128 bits that tell rows apart: two hashes of ``cols``, with different seeds."""
    return F.struct(F.xxhash64(*cols).alias("h"), F.xxhash64(F.lit("second"), *reversed(cols)).alias("g"))
