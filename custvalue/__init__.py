"""Customer-value analytics on Spark.

Invoices in (nested JSON, flat lines, streams), per-customer value features,
scoring, rankings and sinks out.  Every operator is a ``DataFrame -> DataFrame``
function so the same code serves batch jobs and ``foreachBatch`` streams.
"""

__version__ = "0.1.0"
