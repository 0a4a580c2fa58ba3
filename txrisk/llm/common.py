"""What the training-data operators share: tables, batches, intermediate tables, components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from txrisk.session import configure, remove_path, work_dir

# An Arrow batch is closed at whichever comes first, so that a run of very long
# texts cannot fill a Python worker.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 2000


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        top = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="package-")) / f"{top.name}.zip"
        with zipfile.ZipFile(target, "w") as z:
            for file in sorted(top.rglob("*.py")):
                z.write(file, file.relative_to(top.parent))
        context.addPyFile(str(target))  # Spark serves it from the driver
        _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings and code that the operators rely on."""
    ship_package(spark)
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# Lets Spark delete a query's shuffle files when it ends, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors, frees what was shuffled for it."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``keep`` that nothing reads any more."""
    for df in tables:
        for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            remove_path(df.sparkSession, path)


def id_remainder(column: str, modulus: int) -> Column:
    """``crc32(id as text) mod modulus``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column, null as the empty text."""
    return [t or "" for t in column.to_pylist()]


def spans(lengths: np.ndarray) -> np.ndarray:
    """Start offsets of consecutive runs of these lengths, with the total at the end."""
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out




def emit(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


Batches = Iterator[pa.RecordBatch]


def append(docs: DataFrame, fields: str, maker: Callable[[], Callable[[list[str]], list]]) -> DataFrame:
    """``docs`` with columns made from its whole texts, in one map without a shuffle.

    ``maker`` is called once per task and returns a function from texts to the columns named
    in ``fields``, whose names must not occur in ``docs``.
    """
    added = T.StructType.fromDDL(fields)
    types = to_arrow_schema(added)
    at = docs.columns.index("text")

    def run(batches: Batches) -> Batches:
        make = maker()
        for batch in batches:
            new = [pa.array(c, f.type) for c, f in zip(make(texts_of(batch.column(at))), types, strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns + new, names=batch.schema.names + types.names)

    return docs.mapInArrow(run, T.StructType(docs.schema.fields + added.fields))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of an edge table ``(a, b)`` of orderable ids.

    Returns ``(node, root)`` for every node of an edge, ``root`` being the smallest
    node of its component. Alternating large-star and small-star rounds; each round
    is a map-side combined minimum per node joined back to the edges, so that a
    node with very many edges is spread by the skew join, and is written to the shared
    folder. The number of rounds grows with the logarithm of the longest chain.
    """
    edges = keep(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        name,
    )
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Here a > b throughout.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        small = small.select(F.col("e.m").alias("a"), F.col("e.b").alias("b")).where("a <> b").distinct()
        step = keep(small, name)
        # Stars only: every right-hand node has one edge and is nobody's root.
        odd = step.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").limit(1)
        odd = odd.select("b").union(step.select("b").intersect(step.select("a")).limit(1))
        edges = step
        if odd.isEmpty():
            break
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return roots.union(edges.select(F.col("b").alias("node"), F.col("a").alias("root")))
