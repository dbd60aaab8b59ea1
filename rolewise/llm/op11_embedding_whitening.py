"""Whitening of embeddings on distributed block matrices.

Each component c becomes the whole number x = floor(1024 c) + 100000.  Rows are indexed without gaps, centred on the mean
(n x - S, a whole number, divided by n, so nothing is lost to the common offset of 100000) and put into a BlockMatrix of
ROWS x COLS blocks.  Its transpose times itself is the scatter; the middle dimension is split, so each pair of blocks is a
task of its own and only d x d sums meet.  eigh of scatter / n runs on the driver (d x d numbers), and the block matrix
times the whitening matrix (components over the roots of their eigenvalues) projects the rows.  The projection's own
transpose-multiply gives the error against the identity.

Rows without a vector, with an empty one or with null, non-finite or too large (2^52) entries are left out, and so are those whose length is
not that of most vectors (of two equally frequent lengths the greater counts).  Repeated rows, and repeated or null
vec_ids, are separate rows.  A component without variance (eigenvalue at most d * 2^-52 of the greatest: ties of rows, fewer
rows than components) has whitened 0 and no part in the identity error.  An empty table gives an empty result.  Other
columns are ignored, whatever their names.  `deviation` is exact; it is null beyond 63 bits, `deviation_exact` is not.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession, functions as F

from .numbering import indexed
from .stage import staged, table

COMPONENTS = 8
ROWS, COLS = 4096, 512      # of a block: 16 MB at most
SCALE, OFFSET = 1024, 100_000
LARGEST = 2.0 ** 52         # x would not be a whole number of 63 bits
SCHEMA = ("vec_id long, component int, n long, deviation long, deviation_exact decimal(38,0), whitened double, explained double, "
          "identity_error double")


def whole_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and x of the rows that take part."""
    values = F.col("v")
    bad = F.exists(values, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) >= LARGEST))
    usable = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter(
        values.isNotNull() & (F.size("v") > 0) & ~bad)
    most = usable.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("k"), F.desc("d")).first()
    return usable.filter(F.size("v") == (most["d"] if most else 0)).select(
        "vec_id", F.transform("v", lambda v: F.floor(v * SCALE).cast("long") + OFFSET).alias("x"))


def block_matrix(rows: DataFrame, n: int, d: int, rows_per_block: int = ROWS) -> BlockMatrix:
    """Rows (pos, v: array of doubles) as a block matrix, without a detour over Python."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(F.col("pos").cast("long").alias("index"), array_to_vector("v").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, d).toBlockMatrix(rows_per_block, COLS)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """Transpose times itself.  Without splits the whole middle dimension of a result block would be one task."""
    splits = max(1, -(-matrix.numRows() // ROWS))
    turned = matrix.transpose()._java_matrix_wrapper
    product = turned.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, COLS, COLS).toLocalMatrix().toArray()


def components(scattered: np.ndarray, n: int, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues by falling size, whitening matrix (d x k) and each component's share of the whole variance."""
    values, vectors = np.linalg.eigh((scattered + scattered.T) / (2 * n))
    values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
    k = min(k, len(values))
    real = values[:k] > values[0] * len(values) * 2.0 ** -52
    roots = np.where(real, np.sqrt(np.where(real, values[:k], 1.0)), np.inf)
    whole = values.sum()
    return values[:k], vectors[:, :k] / roots, values[:k] / whole if whole > 0 else np.zeros(k)


def whiten(embeddings: DataFrame, k: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, deviation_exact, whitened, explained, identity_error: a row for each vector and component."""
    spark = embeddings.sparkSession
    rows = staged(indexed(whole_vectors(embeddings, vector)))
    head = rows.select("n", F.size("x").alias("d")).first()
    if head is None:
        return spark.createDataFrame([], SCHEMA)
    n, d = head
    ends = rows.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(
        F.sum(F.col("x").cast("decimal(28,0)")).alias("s"), F.min("x").alias("low"), F.max("x").alias("high")).orderBy("i").collect()
    sums = [int(e["s"]) for e in ends]
    widest = max(max(n * e["high"] - int(e["s"]), int(e["s"]) - n * e["low"]) for e in ends)
    fits = widest * widest * d < 1 << 63 and n * max(abs(e[b]) for e in ends for b in ("low", "high")) < 1 << 63
    kind = "long" if fits else "decimal(38,0)"
    total = F.array(*[F.lit(str(s)).cast(kind) for s in sums])
    far = F.zip_with("x", total, lambda x, s: (x.cast(kind) * F.lit(n).cast("long" if fits else "decimal(18,0)") - s).cast(kind))
    centred = staged(rows.select("vec_id", "pos", far.alias("far")))
    matrix = block_matrix(centred.select("pos", F.transform("far", lambda y: y.cast("double") / n).alias("v")), n, d)
    matrix.persist(StorageLevel.MEMORY_AND_DISK)
    values, white, explained = components(scatter(matrix), n, k)
    whitening = spark.createDataFrame([(i, row) for i, row in enumerate(white.tolist())], "pos long, v array<double>")
    projected = matrix.multiply(block_matrix(whitening, d, len(values), COLS)).toIndexedRowMatrix()
    plain = callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model)
    written = staged(plain.select(F.col("index").alias("pos"), vector_to_array("vector").alias("w")))
    matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)
    mean = np.array(written.agg(*[F.avg(F.col("w")[i]) for i in range(len(values))]).first())
    level = written.select("pos", F.zip_with("w", F.array(*map(F.lit, mean.tolist())), lambda w, m: w - m).alias("v"))
    real = np.flatnonzero(np.abs(white).sum(axis=0))
    spread = scatter(block_matrix(level, n, len(values))) / n
    error = float(np.abs(spread - np.eye(len(values)))[np.ix_(real, real)].max(initial=0.0))
    power = F.aggregate("far", F.lit(0).cast(kind), lambda a, y: F.try_add(a, F.try_multiply(y, y)).cast(kind))
    shares = F.array(*map(F.lit, explained.tolist()))
    exact = centred.select("vec_id", "pos", power.cast("decimal(38,0)").alias("deviation_exact"))
    return exact.join(written, "pos").select("vec_id", "deviation_exact", F.posexplode("w").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), F.col("deviation_exact").try_cast("long").alias("deviation"),
        "deviation_exact", "whitened", F.get(shares, F.col("i")).alias("explained"), F.lit(error).alias("identity_error"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
