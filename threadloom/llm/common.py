"""Words, sizes and stored tables shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadloom.sizing import cut_lineage, work_dir

# A table of keys with at most this many rows (16 bytes each, so 8 MB) may be copied to every executor.
BROADCAST_KEYS = 500_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def lower_words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, with A-Z in lower case, as UTF-8."""
    return text.encode().translate(_LOWER).split() if text else []


def store(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared working folder and read again."""
    return cut_lineage(df, label)


def keys_hint(keys: DataFrame, rows: int) -> DataFrame:
    """Broadcast keys when their known number of rows is within BROADCAST_KEYS; shuffle otherwise."""
    return F.broadcast(keys) if rows <= BROADCAST_KEYS else keys


def map_rows(df: DataFrame, function: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str, rows: int = 2000) -> DataFrame:
    """Run function over the rows of each task as tuples; give rows of schema back in Arrow batches of `rows`."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        def tuples():
            for batch in batches:
                for start in range(0, batch.num_rows, 500):
                    part = batch.slice(start, 500)
                    yield from zip(*(c.to_pylist() for c in part.columns))

        held: list[tuple] = []
        for row in function(tuples()):
            held.append(row)
            if len(held) >= rows:
                yield _batch(held, arrow)
                held = []
        if held:
            yield _batch(held, arrow)

    return df.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


__all__ = ["BROADCAST_KEYS", "keys_hint", "lower_words", "map_rows", "store", "work_dir"]
