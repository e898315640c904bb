"""Schema-variance analysis of an index table, as a job with a report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fathom.operators import variance as X
from fathom.sources.inventory import Scan, key_like


def analyse(
    index: DataFrame,
    prefix: str | None = None,
    row_filter: str | None = None,
    column: str = "variable_schema",
    output: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Summary, most frequent schemas, and report of the files below a key pattern.

    Only the key and the variables are read. ``output`` is a folder for the report's text.
    """
    rows = Scan(row_filter=key_like(prefix, row_filter), fields=("key", column)).apply(index)
    report = X.variance_report(rows, column, prefix)
    if output is not None:
        X.write_report(report, output)
    return X.variance_summary(rows, column), X.top_schemas(rows, column), report
