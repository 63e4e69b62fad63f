"""User code next to built-in functions.

The built-in form is always the first choice; these show how code that has
no column form is run, vectorised over Arrow batches. Aggregates of user code are in
``operators/user_aggregate.py``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.arrow_udf(T.ArrayType(T.StringType()))
def split_words(lines: pa.Array) -> pa.Array:
    """Words of each line; a missing line has none. Column form: ``parse.words``.

    Words stay in Arrow's buffers: as Python texts those of ten thousand long lines take many times their size.
    """
    split = pc.split_pattern_regex(lines.cast(pa.string()).fill_null(""), r"[ \t\n\x0B\f\r]+")
    words = split.flatten()
    real = pc.not_equal(words, "")
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    bounds = split.offsets.to_numpy()
    return pa.ListArray.from_arrays(pa.array(before[bounds - bounds[0]], pa.int32()), words.filter(real))


@F.pandas_udf(T.IntegerType())
def fail_from_ten(numbers: pd.Series) -> pd.Series:
    """Numbers below ten as they are; fails the query on any other."""
    over = numbers[numbers >= 10]
    if len(over):
        raise ValueError(f"value is not below 10: {int(over.iloc[0])}")
    return numbers


def average(column: Column) -> Column:
    """Average from a sum and a count, both merged map-side."""
    return F.sum(column.cast("bigint")) / F.count(column)


def register(spark: SparkSession) -> None:
    """Make the user functions callable from SQL text."""
    spark.udf.register("split_words", split_words)
    spark.udf.register("fail_from_ten", fail_from_ten)
