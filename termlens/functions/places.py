"""Where the tokens of a text stand, in code points.

Tokens and the gaps between them are found natively (``text.token_array``, ``text.gap_array``).  Their
lengths are summed up here: an Arrow batch holds whole documents, and the sums of all of them are one
running sum, less what had come before each document.  No string leaves the JVM.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.arrow_udf(T.StructType([T.StructField(name, T.ArrayType(T.LongType())) for name in ("position", "start", "end")]))
def _places(lengths: pa.Array, gaps: pa.Array) -> pa.Array:
    """Arrow in, Arrow out: positions, starts and ends, aligned with the tokens.  A document has one gap
    more than tokens, and a token starts after all earlier tokens and gaps, its own gap included."""
    counts = pc.fill_null(pc.list_value_length(lengths), 0).to_numpy().astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(counts)))
    length = lengths.flatten().to_numpy().astype(np.int64)
    gap = gaps.flatten().to_numpy().astype(np.int64)
    held = np.flatnonzero(pc.is_valid(gaps).to_numpy(zero_copy_only=False))
    last = offsets[held + 1] + np.arange(len(held))  # the gap after a document's last token
    end = np.cumsum(length + np.delete(gap, last))
    before = np.concatenate(([0], end))[offsets[:-1]]
    end -= np.repeat(before, counts)
    position = np.arange(len(end)) - np.repeat(offsets[:-1], counts)
    lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int64()), mask=lengths.is_null())
             for x in (position, end - length, end)]
    return pa.StructArray.from_arrays(lists, ["position", "start", "end"])


# Ship this module's code with the UDF, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def places(tokens: Column, gaps: Column) -> Column:
    """struct<position, start, end> of arrays aligned with ``tokens``, given the strings between them."""
    return _places(F.transform(tokens, lambda t: F.length(t)), F.transform(gaps, lambda g: F.length(g)))
