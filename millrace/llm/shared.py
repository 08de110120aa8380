"""What the operators share: the folder all executors see, written tables, words of a text."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import checkpoint_root

# The separators of the word and line contracts, as a regular expression class.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"
# Rows of a batch that a worker turns into Python objects or arrays at once.
SLICE = 500
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session without that setting (tests) gets a temporary folder; a
    cluster without it is an error, because a machine-local folder would be lost
    with its machine.
    """
    fallback = None
    if spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        fallback = tempfile.gettempdir()
    return f"{checkpoint_root(spark, fallback)}/millrace-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    This cuts the lineage: what follows reads the files, also after an executor is lost.  Nothing reads the shuffles of the
    write again; with ``free`` Spark removes their files as soon as it has ended, for steps that move much.
    The folder belongs to the application and may be removed when that has ended.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true" if free else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Delete the folder of a :func:`written` table, once nothing that will still run reads it."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_bytes(text: Column) -> Column:
    """UTF-8 bytes, empty for null; Python then never has to decode a damaged string."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def word_list(text: Column) -> Column:
    """Runs of non-space characters; an empty array for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"))


def literal_array(values, kind: str) -> Column:
    """A constant array as one folded literal, however long (an array of literals would be one expression each)."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows.

    An idle worker keeps what memory its largest step took, so what a step makes of a batch must not grow with the batch.
    """
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)
