"""What the operators on documents share: Arrow passes over (id, text) with any other columns left out, and folders that all executors see."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch; with texts of a few KB a batch has a few MB.
BATCH_ROWS = 500


def session(df: DataFrame) -> SparkSession:
    """The session, with Arrow batches small enough for a worker's memory, and this package on the workers' path."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def slim(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id, as bigint, and the text; names that clash with the operator's own can't do so."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def map_texts(df: DataFrame, body: Callable[[pa.RecordBatch], pa.RecordBatch | list[pa.RecordBatch]], schema: str) -> DataFrame:
    """`body` for each Arrow batch, in the order of the rows; no shuffle."""
    session(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = body(batch)
                yield from made if isinstance(made, list) else [made]

    return df.mapInArrow(run, schema)


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the one that all executors share; spark.checkpoint.dir is set only where nothing has set it, as in tests."""
    import tempfile

    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        at = spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = f"file://{tempfile.gettempdir()}/ratevane-shared"
        spark.sparkContext.setCheckpointDir(at)
    own = f"{at.rstrip('/')}/ratevane-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(own)
    return own


_made: dict[str, list[str]] = {}


def clear_shared(spark: SparkSession) -> None:
    """Deletes the tables that this session's operators left in the shared folder; what is still to be read from them must be done."""
    jvm = spark.sparkContext._jvm
    for at in _made.pop(spark.sparkContext.applicationId, []):
        path = jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """`df` as a table in the shared folder, read back: cuts the lineage, and lost executors take nothing with them."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/{name}"
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def hashed_mod(id_col: str, n: int):
    """crc32 of the id as text, modulo n: the folds."""
    return F.crc32(F.col(id_col).cast("string")) % n


def filter_texts(df: DataFrame, text_col: str, keep: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """The rows for whose texts `keep` gives true, with all their columns; one pass, no shuffle."""
    session(df)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(keep(batch.column(at)))

    return df.mapInArrow(run, df.schema)


#: Stands for a null id where ids are compared.
NO_ID = -(1 << 63)


def id_key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))


def less(df: DataFrame, id_col: str, own: Column, marks: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """`df` less the rows that `marks` (key, own, stays) names by id_key() and `own`, a hash of the text; all other rows stay, null ids too.

    Where `stays` is true, several rows have that id and text: one of them stays, whichever. Up to `broadcast_rows` marks are broadcast, more are joined by a shuffle.
    """
    marks = written(marks.toDF("__key", "__own", "__stays"), "marks")
    few = marks.count() <= broadcast_rows

    def named(side: DataFrame, how: str) -> DataFrame:
        return df.join(F.broadcast(side) if few else side, (id_key(id_col) == F.col("__key")) & (own == F.col("__own")), how)

    out, again = named(marks, "left_anti"), marks.where("__stays")
    if again.isEmpty():
        return out
    one = named(again, "left_semi").withColumn("__key", id_key(id_col)).withColumn("__own", own).dropDuplicates(["__key", "__own"])
    return out.union(one.select(df.columns))
