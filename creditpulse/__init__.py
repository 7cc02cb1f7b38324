"""Loan and risk metrics on Spark.

Three jobs, all written with DataFrames, Spark SQL and Structured Streaming:

* live metrics: JSON business logs -> per-record metric deltas -> daily and
  two-minute counters, with bad records set aside with a reason;
* backfill: the same counters recomputed from detail tables over a time range
  and merged with the live counters at a cut-over time;
* graph export: vertex/edge pattern match, key-list filter, entity projection
  and size-rolled CSV files.
"""

__version__ = "0.1.0"
