"""Vector columns of the machine-learning library, made without Python workers."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The type tag that marks a sparse vector in the library's vector type.
SPARSE = 0


def sparse_vector(size: Column, indices: Column, values: Column) -> Column:
    """A sparse vector from its size, its rising indices and as many values; null if one of them is null.

    Indices that don't rise, lie outside the size or are not as many as the values stop the job.
    """
    n = F.size(indices)
    places = F.sequence(F.lit(1), n - 1)
    rising = F.when(n < 2, True).otherwise(F.forall(places, lambda i: F.get(indices, i) > F.get(indices, i - 1)))
    inside = F.forall(indices, lambda i: (i >= 0) & (i < size))
    whole = (n == F.size(values)) & F.coalesce(rising & inside, F.lit(False)) & F.forall(values, lambda v: v.isNotNull())
    fields = F.struct(F.lit(SPARSE).cast("byte").alias("type"), size.cast("int").alias("size"),
                      indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"))
    error = F.raise_error(F.lit("indices and values make no sparse vector")).cast("string")
    checked = F.when(whole, fields_json(fields)).otherwise(error)
    text = F.when(size.isNotNull() & indices.isNotNull() & values.isNotNull(), checked)
    # only a reader makes the library's type out of its fields; numbers survive being written and read
    return F.from_json(text, StructType().add("v", VectorUDT()))["v"]


def fields_json(fields: Column) -> Column:
    return F.to_json(F.struct(fields.alias("v")))


def sparse_of(dense: Column) -> Column:
    """The sparse vector of an array of numbers: its values other than zero."""
    at = F.filter(F.sequence(F.lit(0), F.size(dense) - 1), lambda i: F.get(dense, i) != 0)
    at = F.when(F.size(dense) > 0, at).otherwise(F.array().cast("array<int>"))
    return sparse_vector(F.size(dense), at, F.transform(at, lambda i: F.get(dense, i).cast("double")))


def parts(vector: Column) -> Column:
    """The fields ``type, size, indices, values`` of a vector column."""
    return F.unwrap_udt(vector)
