"""Helpers shared by the operators: table reading, row keys, the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest lookup the operators broadcast, in bytes of its values.
BROADCAST_MAX_BYTES = 16 << 20
#: Row groups of stored texts: what a writing task buffers, and the least split of a later scan.
ROW_GROUP_BYTES = 32 << 20
#: Name of the internal row key; extra input columns never reach the operators,
#: which select the two columns they need first, so it cannot clash.
ROW = "_row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (any store Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, doc_id, text) of every row: ids may repeat or be null, _row is unique.

    The key comes from the position in the scan, which follows the scan's
    splits, and these follow the cores that are registered when a job starts.
    Another pass may therefore give other keys: whatever joins by the key reads
    ``stored`` rows.
    """
    return docs.select(
        F.monotonically_increasing_id().alias(ROW), name(id_col).alias("doc_id"), name(text_col).alias("text")
    )


#: Name of the struct that carries whole rows beside the key.
DOC = "_doc"


def rows(docs: DataFrame) -> DataFrame:
    """(_row, _doc) of every row, keyed like ``keyed``; no column name of ``docs`` can clash."""
    return docs.select(F.monotonically_increasing_id().alias(ROW), F.struct(*[name(c) for c in docs.columns]).alias(DOC))


def name(column: str, of: str | None = None) -> Column:
    """The column of exactly this name (dots and spaces included), or the field of a struct."""
    quoted = "`" + column.replace("`", "``") + "`"
    return F.col(f"{of}.{quoted}" if of else quoted)


def whole(docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` out of ``rows(docs)``."""
    return [name(c, DOC).alias(c) for c in docs.columns]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once, also when body is a lambda over an array."""
    return F.transform(F.array(value), body).getItem(0)


#: The folder of the run that is going on, see ``run_folder``.
_RUN: ContextVar[str | None] = ContextVar("_RUN", default=None)


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Everything that operators write inside goes below one folder, which is removed at the end.

    Results are read from there: use or write them inside.  Without it the
    tables stay below ``spark.checkpoint.dir`` until its owner clears it.
    """
    path = shared_dir(spark)
    before = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(before)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shared_dir(spark: SparkSession) -> str:
    """A new folder (its URI, not yet made) below ``spark.checkpoint.dir``, or that of the run.

    The setting names storage that all executors share.  Where it is unset, a
    temporary folder is used on a local master (one machine, as in tests) and
    a cluster is refused.
    """
    if _RUN.get():
        return f"{_RUN.get()}/{uuid.uuid4().hex}"
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="llm-")
    if "://" not in root:  # a bare path belongs to Spark's default store, also for readers outside of Spark
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
        root = "file://" + root.removeprefix("file:") if root.startswith("file:") else root
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(rows: DataFrame) -> DataFrame:
    """The rows of ``keyed`` or ``rows`` written once: every pass over the result reads the same keys."""
    return written(rows, "rows", compression="zstd", **{"parquet.block.size": str(ROW_GROUP_BYTES)})


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once a Spark context.

    Operators with Python stages import it there.  Nothing is sent where the
    package already comes from an archive (``--py-files``).
    """
    sc = spark.sparkContext
    package = Path(__file__).resolve().parent.parent
    if not package.is_dir() or getattr(sc, "_llm_shipped", False):
        return
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="llm-code-")), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    sc.addPyFile(archive)
    sc._llm_shipped = True
