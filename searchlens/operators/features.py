"""Category encoding (J1, J2) for any number of labels.

The vocabulary is a table, not a list on the driver: labels are counted with
map-side combine, numbered in a distributed order, and joined back, the hot
ones by broadcast. One-hot vectors are sparse, made by Spark ML's encoder
model for a given number of labels.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import written
from .numbering import numbered
from .skew import skew_join

# What a vector looks like inside: sparse (type 0) or dense.
VECTOR_FIELDS = "struct<v: struct<type: tinyint, size: int, indices: array<int>, values: array<double>>>"


def _label_order(order: str) -> list[Column]:
    count, label = F.col("n"), F.col("label")
    return {"frequencyDesc": [count.desc(), label.asc()], "frequencyAsc": [count.asc(), label.asc()],
            "alphabetDesc": [label.desc()], "alphabetAsc": [label.asc()]}[order]


def category_vocabulary(df: DataFrame, input_col: str, order: str = "frequencyDesc") -> DataFrame:
    """(label, n, index) of every label but NULL; equal counts are numbered alphabetically."""
    counts = df.where(F.col(input_col).isNotNull()).groupBy(F.col(input_col).cast("string").alias("label")).agg(
        F.count(F.lit(1)).alias("n"))
    return written(numbered(counts, _label_order(order), "index"), "vocabulary")


def index_categories(df: DataFrame, input_col: str, output_col: str = "category_index",
                     order: str = "frequencyDesc", vocabulary: DataFrame | None = None) -> DataFrame:
    """Label index by falling frequency (ties alphabetical); the most frequent label is 0, as a double.

    A NULL label has no index.
    """
    vocabulary = category_vocabulary(df, input_col, order) if vocabulary is None else vocabulary
    key = "_label"
    dim = vocabulary.select(F.col("label").alias(key), F.col("index").cast("double").alias(output_col))
    counts = vocabulary.select(F.col("label").alias(key), "n")
    labelled = df.withColumn(key, F.col(input_col).cast("string"))
    return skew_join(labelled, dim, key, "left", counts).select(*df.columns, output_col)


def encode_categories(df: DataFrame, input_col: str, output_col: str = "category_vec",
                      index_col: str = "category_index", drop_last: bool = True) -> DataFrame:
    """Sparse one-hot vectors of the label index; with ``drop_last`` the last label is all zeros. NULL stays NULL."""
    vocabulary = category_vocabulary(df, input_col)
    labels = max(vocabulary.count(), 2)   # the encoder wants two labels at least
    # The encoder model holds nothing but the number of labels, which it reads off the largest index.
    largest = df.sparkSession.range(labels - 1, labels).select(F.col("id").cast("double").alias(index_col))
    model = OneHotEncoder(inputCols=[index_col], outputCols=[output_col], dropLast=drop_last).fit(largest)
    return model.transform(index_categories(df, input_col, index_col, vocabulary=vocabulary))


def vector_columns(df: DataFrame, vec_col: str) -> DataFrame:
    """A one-hot vector as plain columns: its size and the active position (NULL when all zero)."""
    fields = F.from_json(F.to_json(F.struct(F.col(vec_col).alias("v"))), VECTOR_FIELDS)["v"]
    return df.withColumn("vec_size", fields["size"]).withColumn("vec_active", F.get(fields["indices"], F.lit(0)))
