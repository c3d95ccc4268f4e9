"""What several operators share: tables, task code by value, staged steps, connected components."""

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barwright.session import new_folder

#: Words of the licence and benchmark contracts: every ASCII byte but digits and letters separates.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
#: The same words for Spark's regular expressions, on lower-cased text.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def by_value(module: str) -> None:
    """Send the functions of this module to the executors with the job, not by their import path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


by_value(__name__)


def slices(batches, rows: int):
    """Arrow batches in pieces of a few rows, so that little of them is held as Python objects at once.

    Afterwards what Arrow has kept for further batches goes back to the system: the worker lives on.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text):
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def word_array(text):
    """The words of a text; a null text has none."""
    return split_words(ascii_lower(F.coalesce(text, F.lit(""))))


def split_words(text):
    return F.array_remove(F.split(text, NOT_WORD), "")


def stage(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, and the folder it lies in."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove staged tables that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return (
        both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least).distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Connected components: ``node`` and ``component`` (its smallest node) of all linked nodes.

    Alternates large-star and small-star steps until nothing moves. Every step is two shuffles of the
    edges, written to the shared folder. Minima are gathered map-side; a node's edges meet its minimum in
    a streamed join, which adaptive skew handling splits for a node of very many. The rounds grow with the
    logarithm of the longest path.
    """
    spark = edges.sparkSession
    a, b = F.col(left), F.col(right)
    current = edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    current, path = stage(current, "edges")
    seen = None
    while True:
        told = Observation()
        step = _small_star(_large_star(current)).observe(
            told, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("mark")
        )
        after, after_path = stage(step, "edges")
        state = (told.get["n"], told.get["mark"])
        discard(spark, path)
        current, path = after, after_path
        if state == seen or state[0] == 0:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                current.select("v", "v").distinct()
            )
        seen = state
