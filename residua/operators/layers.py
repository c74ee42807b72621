"""The largest weight over layers and heads, taken in as they come."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.session import bound_arrow_batches, shuffle_partitions

#: Numbers that a task holds in accumulators before it passes them on.
MOST_HELD = 1 << 24


def _folded(kind: pa.DataType, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[object, np.ndarray] = {}
        size = 0  # numbers held

        def out(keys: list) -> pa.RecordBatch:
            rows = [held.pop(k) for k in keys]
            offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            values = pa.array(np.concatenate(rows))
            return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.ListArray.from_arrays(pa.array(offsets), values)], names=["key", "weights"])

        for batch in batches:
            column = batch.column(1)
            offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            for k, key in enumerate(batch.column(0).to_pylist()):
                row = values[offsets[k] : offsets[k + 1]]
                acc = held.get(key)
                if acc is None:
                    while held and size + len(row) > most:
                        oldest = next(iter(held))
                        size -= len(held[oldest])
                        yield out([oldest])
                    held[key] = row.astype(np.float32)
                    size += len(row)
                elif len(acc) != len(row):
                    raise ValueError(f"weights of {len(acc)} and of {len(row)} numbers under {key!r}")
                else:
                    np.maximum(acc, row, out=acc)
        for key in list(held):
            yield out([key])

    return run


def layer_maximum(rows: DataFrame, key: str, weights: str, most_held: int = MOST_HELD) -> DataFrame:
    """key, weights: the largest of each place over all rows of a key, which hold a layer's or a head's n x n weights.

    A task folds each row into its key's one accumulator, so memory doesn't grow with layers; the accumulators
    of a key, one a task, are folded again after a shuffle. A task holds accumulators of most_held numbers in
    all, or one, and passes the oldest on when there are more. Rows of a key must be of one length; null
    weights are left out; NaN is larger than any number.
    """
    bound_arrow_batches(rows.sparkSession)
    rows = rows.select(F.col(key).alias("key"), F.col(weights).cast("array<float>").alias("weights")).filter(F.col("weights").isNotNull())
    kind = rows.schema["key"].dataType
    schema = f"key {kind.simpleString()}, weights array<float>"
    from pyspark.sql.pandas.types import to_arrow_type

    fold = _folded(to_arrow_type(kind), most_held)
    partial = rows.mapInArrow(fold, schema).repartition(shuffle_partitions(rows.sparkSession), "key").sortWithinPartitions("key")
    # In order of keys only one accumulator is open at a time.
    whole = partial.mapInArrow(_folded(to_arrow_type(kind), 0), schema)
    return whole.select(F.col("key").alias(key), "weights")
