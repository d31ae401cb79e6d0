"""Documents dealt into groups by a hash and packed, so that one shuffle of compressed text serves several steps."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes of a group.
GROUP_BYTES = 16 << 20


def number_of_groups(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, math.ceil(size / GROUP_BYTES))


def packed(docs: DataFrame, groups: int, columns: list[str]) -> DataFrame:
    """(group, docs): the given columns of the rows of a group, as compressed Arrow, in as many rows as there were batches.

    A plan that groups the result by group several times shuffles it once.
    """

    def pack(batches):
        for batch in batches:
            group = batch.column(0).to_numpy(zero_copy_only=False)
            order = np.argsort(group, kind="stable")
            rows = batch.select(columns).take(pa.array(order))
            starts = np.flatnonzero(np.diff(group[order], prepend=-1))
            blobs = []
            for lo, hi in zip(starts, [*starts[1:], len(order)]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_batch(rows.slice(lo, hi - lo))
                blobs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(group[order][starts]), pa.array(blobs, pa.binary())], ["group", "docs"])

    group = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).alias("group")
    return docs.select(group, *columns).mapInArrow(pack, "group long, docs binary")


def unpacked(blobs: pd.Series) -> Iterator[pa.RecordBatch]:
    for blob in blobs:
        yield from pa.ipc.open_stream(blob)
