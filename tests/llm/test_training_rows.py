"""No training row is lost, however long the texts are."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa

from tidefold.llm.toxicity import _stored


def test_all_long_rows_are_kept():
    long = np.arange(1 << 20, dtype=np.int32)

    def batches():
        for order in range(52):
            at = long if order < 50 else np.array([7, 9][: order - 50], np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([order]), pa.array([order % 2]), pa.array([at], pa.list_(pa.int32()))], names=["order", "label", "at"]
            )

    with tempfile.TemporaryFile() as spill:
        rows = _stored(batches(), spill)
        assert [label for label, _ in rows] == [order % 2 for order in range(52)]
        assert sum(len(at) for _, at in rows) == (50 << 20) + 1 and (rows[49][1] == long).all() and rows[51][1].tolist() == [7]
