"""Whiten embeddings by a weighted covariance over distinct vectors.

1. Entries become whole numbers x = floor(1024 c) + 100000. Equal x vectors are one row with the
   number of their copies (combined before the shuffle, so a vector with a third of all rows is one row
   per task).
2. Sums are exact integers. The covariance is a matrix product of the centred vectors, scaled by the
   square root of their weights (copies, or one), per Arrow batch; a task sends on one matrix.
3. The eigenvectors are taken on the driver, whose matrices have as many entries as a vector has squared.
4. Each distinct vector is whitened once, and joined back to the rows by a 128-bit hash of x. What the
   whitened vectors' covariance lacks to the identity is measured on all of them.

Defined results: a NULL vector, and one with a NULL, NaN or infinite entry or one beyond 2**40, is
dropped. Of vectors of several lengths those of the most frequent length stay (of equally frequent
ones the longest). Rows with one id, or none, each have their own rows in the result. A component without variance has
NULL as ``whitened`` and stays out of the identity error; without any variance ``explained`` is 0. A
deviation is exact, and NULL beyond 38 digits. An empty table, and one of empty vectors, gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE, OFFSET = 1024, 100_000
MOST_ENTRY = 2.0 ** 40
COMPONENTS = 8
LEAST_SHARE = 1e-12  # of the greatest eigenvalue; below it a component has no variance


@dataclass
class Whitening:
    """What is learned: exact sums, and unit eigenvectors as columns by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    def shift(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole numbers and a rest, so that centring loses no digits."""
        return (np.array([s // self.n for s in self.sums], np.int64),
                np.array([(s % self.n) / self.n for s in self.sums]))

    def explained(self) -> np.ndarray:
        total = self.values.sum()
        return self.values / total if total > 0 else np.zeros(len(self.values))


def integers(vector: Column) -> Column:
    """x of a vector, NULL if an entry has none."""
    usable = F.forall(vector, lambda c: F.coalesce(
        F.abs(c.cast("double")) <= MOST_ENTRY, F.lit(False)))
    return F.when(usable, F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET))


def _keyed(embeddings: DataFrame, vec_id: str, vector: str) -> DataFrame:
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), integers(F.col(vector)).alias("x"))
    return rows.where("x is not null").select(
        "vec_id", "x", F.xxhash64("x").alias("key_1"), F.xxhash64(F.lit(1), "x").alias("key_2"))


def distinct_vectors(embeddings: DataFrame, vec_id: str = "vec_id",
                     vector: str = "embedding") -> DataFrame:
    """x, its 128-bit key, and ``copies``: the rows that have it."""
    return (_keyed(embeddings, vec_id, vector).groupBy("key_1", "key_2", "x")
            .agg(F.count(F.lit(1)).alias("copies")))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column without NULLs as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, total) of rows (vector, weight); place -1 is the sum of the weights."""
    total: np.ndarray | None = None
    for batch in batches:
        if batch.num_rows:
            x, weight = _matrix(batch.column(0)), batch.column(1).to_numpy()
            greatest = max(1.0, float(np.abs(x).max(initial=0))) * float(weight.sum())
            if x.dtype == np.int64 and greatest >= 2.0 ** 62:
                x = x.astype(object)  # exact at any size
            more = np.append((x * weight[:, None]).sum(axis=0), weight.sum()).astype(object)
            total = more if total is None else total + more
    if total is not None:
        places = [*range(len(total) - 1), -1]
        exact = all(isinstance(v, (int, np.integer)) for v in total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int32()),
             pa.array([Decimal(int(v)) if exact else None for v in total], pa.decimal128(38, 0)),
             pa.array([float(v) for v in total], pa.float64())],
            names=["place", "exact", "rounded"])


def _totals(table: DataFrame, vector: str, weight: Column, exact: bool):
    """The sum of the weights, and of the weighted vectors; a row per task and dimension is summed."""
    column = "exact" if exact else "rounded"
    found = {r["place"]: r["total"] for r in table.select(vector, weight.cast("long")).mapInArrow(
        _sums, "place int, exact decimal(38,0), rounded double")
        .groupBy("place").agg(F.sum(column).alias("total")).collect()}
    n = int(found.pop(-1, 0))
    kind = int if exact else float
    return n, [kind(found[i]) for i in sorted(found)]


def _products(whole: np.ndarray, rest: np.ndarray):
    """The sum of weighted products of centred vectors, one matrix per task."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(whole), len(whole)))
        for batch in batches:
            if batch.num_rows:
                centred = (_matrix(batch.column(0)) - whole) - rest
                centred *= np.sqrt(batch.column(1).to_numpy())[:, None]
                total += centred.T @ centred
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))],
                                         names=["products"])
    return multiply


def _covariance(table: DataFrame, vector: str, weight: Column, n: int, whole: np.ndarray,
                rest: np.ndarray) -> np.ndarray:
    size = len(whole)
    found = (table.select(vector, weight.cast("long")).mapInArrow(_products(whole, rest), "products array<double>")
             .select(F.posexplode("products").alias("place", "product"))
             .groupBy("place").agg(F.sum("product").alias("product")).collect())
    out = np.zeros(size * size)
    for row in found:
        out[row["place"]] = row["product"]
    out = out.reshape(size, size) / n
    return (out + out.T) / 2


def fit(distinct: DataFrame, weights: str = "copies") -> Whitening | None:
    """``weights``: ``copies``, so that every row counts, or ``one``, so that every vector does."""
    weight = F.col("copies") if weights == "copies" else F.lit(1)
    n, sums = _totals(distinct, "x", weight, exact=True)
    if not n or not sums:
        return None
    model = Whitening(n, sums, np.zeros(0), np.zeros((0, 0)))
    values, vectors = np.linalg.eigh(_covariance(distinct, "x", weight, n, *model.shift()))
    model.values, model.vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    return model


def _deviations(x: np.ndarray, model: Whitening) -> list[int]:
    """Sum over dimensions of (n x - S)**2, exactly."""
    bound = float(np.abs(x).max(initial=1)) * model.n + max(map(abs, model.sums))
    if bound < 2.0 ** 62 and x.shape[1] * bound ** 2 < 2.0 ** 62:
        apart = x * model.n - np.array(model.sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    if bound < 2.0 ** 62:  # the products of the differences may still fit
        apart = x * model.n - np.array(model.sums, np.int64)
        if x.shape[1] * float(np.abs(apart).max(initial=0)) ** 2 < 2.0 ** 62:
            return (apart * apart).sum(axis=1).tolist()
    apart = x.astype(object) * model.n - np.array(model.sums, object)
    return (apart * apart).sum(axis=1).tolist()


def _whitened(model: Whitening, components: int):
    """(copies, keys, x) to (copies, keys, deviation, z)."""
    whole, rest = model.shift()
    values = model.values[:components]
    usable = values > LEAST_SHARE * max(float(model.values[0]), 1e-300)
    scale = np.where(usable, 1 / np.sqrt(np.where(usable, values, 1)), 0)
    turn = model.vectors[:, :components] * scale

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(3))
                z = ((x - whole) - rest) @ turn
                offsets = np.arange(0, z.size + 1, z.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3],
                     pa.array([Decimal(d) if d < 10 ** 38 else None for d in _deviations(x, model)],
                              pa.decimal128(38, 0)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(z.ravel()))],
                    names=["copies", "key_1", "key_2", "deviation", "z"])
    return whiten, usable


def whiten(embeddings: DataFrame, components: int = COMPONENTS, weights: str = "copies",
           vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component from 1, n, deviation (38 digits),
    whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "whitening")
    distinct = scratch.table(distinct_vectors(embeddings, vec_id, vector), "distinct")
    length = (distinct.groupBy(F.size("x").alias("length")).agg(F.sum("copies").alias("rows"))
              .orderBy(F.desc("rows"), F.desc("length")).limit(1).collect())
    distinct = distinct.where(F.size("x") == (length[0]["length"] if length else 0))
    model = fit(distinct, weights)
    kind = dict(embeddings.select(F.col(vec_id).alias("vec_id")).dtypes)["vec_id"]
    if model is None:
        return spark.createDataFrame([], f"vec_id {kind}, component int, n long, "
                                         "deviation decimal(38,0), whitened double, "
                                         "explained double, identity_error double")
    function, usable = _whitened(model, components)
    table = scratch.table(
        distinct.select("copies", "key_1", "key_2", "x").mapInArrow(
            function, "copies long, key_1 long, key_2 long, deviation decimal(38,0), "
                      "z array<double>"), "whitened")
    weight = F.col("copies") if weights == "copies" else F.lit(1)
    _, mean = _totals(table, "z", weight, exact=False)
    apart = _covariance(table, "z", weight, model.n, np.zeros(len(mean), np.int64),
                        np.array(mean) / model.n) - np.eye(len(mean))
    apart = apart[usable][:, usable]
    error = float(np.abs(apart).max(initial=0))
    numbers = F.array(*[F.struct(
        F.lit(i + 1).alias("component"), F.lit(float(share)).alias("explained"),
        F.lit(bool(usable[i])).alias("usable"))
        for i, share in enumerate(model.explained()[:len(mean)])])
    rows = _keyed(embeddings, vec_id, vector).select("vec_id", "key_1", "key_2")
    each = (rows.join(table.select("key_1", "key_2", "deviation", "z"), ["key_1", "key_2"])
            .select("vec_id", "deviation", F.explode(F.arrays_zip(
                F.col("z").alias("z"), numbers.alias("of"))).alias("each")))
    return each.select(
        "vec_id", "each.of.component", F.lit(model.n).cast("long").alias("n"), "deviation",
        F.when(F.col("each.of.usable"), F.col("each.z")).alias("whitened"),
        "each.of.explained", F.lit(error).alias("identity_error"))
