"""Reading the corpus tables, and settings that the text operators share."""

from __future__ import annotations

import tempfile
import weakref
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure, stage

#: Rows and bytes per Arrow batch: batches of long documents still fit beside the executor's heap.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20

#: Row number that tells rows apart which share an id, or have none.
ROW = "_row_number"


_shipped: weakref.WeakSet = weakref.WeakSet()


def ship_package(spark: SparkSession) -> None:
    """Give the tasks' Python this package, once per Spark context, as ``--py-files`` would."""
    context = spark.sparkContext
    if context in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted([*package.rglob("*.py"), *package.rglob("*.json")]):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context)


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings that results or memory depend on, and the package for the tasks."""
    configure(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as the empty one: other columns of any name
    never reach an operator."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def identified(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, bool]:
    """``docs`` with column ``ROW``, a number that tells all rows apart, and whether that is the
    id of every row.

    A row that has its id alone keeps it as its number. Rows that share one, or have none, are
    written out with numbers above all ids; where ids leave no room, all rows are.
    """
    own = F.col(f"`{id_col}`").cast("long")
    shared = stage(docs.groupBy(own.alias("_shared")).agg(F.count("*").alias("_n"))
                   .where((F.col("_n") > 1) | F.col("_shared").isNull()).select("_shared"), "shared-ids")
    if shared.isEmpty():
        return docs.withColumn(ROW, own), True
    top = docs.agg(F.max(own)).head()[0] or 0
    if top >= 1 << 61:
        return stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered"), False
    met = own.eqNullSafe(F.col("_shared"))
    number = F.monotonically_increasing_id() + F.lit(max(top, 0) + 1)
    odd = stage(docs.join(shared, met, "left_semi").withColumn(ROW, number), "numbered")
    return docs.join(shared, met, "left_anti").withColumn(ROW, own).unionByName(odd), False


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``rows`` (see ``identified``) whose number is not in ``gone`` (column ``gone``), less
    the number. The numbers are written out, so that their size is known before any text moves."""
    gone = stage(gone, "gone")
    return rows.join(gone, rows[ROW] == gone["gone"], "left_anti").drop(ROW)
