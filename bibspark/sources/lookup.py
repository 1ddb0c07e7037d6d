"""Record lookup by key through a caller-supplied fetch function."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from bibspark.functions.status import RESPONSE_DDL
from bibspark.operators.dedupe import distinct_values


def fetch_responses(rows: DataFrame, fetch: Callable[[list[str]], Iterable[dict]],
                    key: str = "doi", tasks: int = 64) -> DataFrame:
    """Look up every distinct key once, in ``tasks`` parallel streams.

    ``fetch`` gets the keys of one Arrow batch and yields response records
    (doi, http_status, error_kind, error_message, body). Write the result to a
    table before joining it: a lost executor would otherwise fetch again.
    """
    def run(batches):
        import pyarrow as pa

        schema = pa.schema([
            ("doi", pa.string()), ("http_status", pa.int32()), ("error_kind", pa.string()),
            ("error_message", pa.string()), ("body", pa.string()),
        ])
        for batch in batches:
            found = list(fetch(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    keys = distinct_values(rows, key)
    return keys.repartition(tasks, key).mapInArrow(run, RESPONSE_DDL)
