"""Arrow batches as pandas frames, without losing integers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def map_frames(df: DataFrame, work: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str | StructType) -> DataFrame:
    """mapInPandas() whose integer columns stay integers beside nulls.

    mapInPandas() makes doubles of an integer column that holds a null, which changes ids above 2^53.
    Here such a column is one of objects, ints and None; a column without nulls is an array as there.
    """
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in work(b.to_pandas(integer_object_nulls=True) for b in found):
            yield pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)

    return df.mapInArrow(batches, kind)
