"""Arrow batches in pieces of bounded size, for Python that works on their rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

# A session bounds Arrow batches to 10,000 rows and 64 MiB; as Python objects, with what is made of
# them, they are several times that in every worker.
PIECE_BYTES = 1 << 20


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in order, without a copy: of ``PIECE_BYTES`` at most, or one row that is larger."""
    if batch.num_rows > 1 and batch.nbytes > PIECE_BYTES:
        half = batch.num_rows // 2
        yield from pieces(batch.slice(0, half))
        yield from pieces(batch.slice(half))
    else:
        yield batch
