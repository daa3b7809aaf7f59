"""Hand-written raw reports, in the shape the page reader yields."""

import json

from pyspark.sql import types as T

from devicewatch import schemas as S

_SCHEMA = T.StructType([
    *S.RAW_SCHEMA.fields,
    *(T.StructField(n, T.StringType()) for n in (S.RUN_ID, S.SOURCE_FILE))])


def raw(spark, *reports):
    """A DataFrame of raw reports from dicts. Nested values may be objects or JSON text."""
    rows = []
    for report in reports:
        row = {"_run_id": "r1", "_source_file": "landing/page.json",
               "_ingested_at": "2024-01-01T00:00:00Z", **report}
        rows.append(tuple(
            json.dumps(row[n]) if isinstance(row.get(n), (list, dict)) else row.get(n)
            for n in _SCHEMA.names))
    return spark.createDataFrame(rows, _SCHEMA)


def rows(df, *columns):
    """Result rows as tuples of the given columns, sorted; NULL first."""
    got = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(got, key=lambda r: [(v is not None, str(v)) for v in r])
