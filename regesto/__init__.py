"""regesto: captured pages of Italian regional law portals -> one typed law index, on Spark.

Modules:
  functions  Column functions (text, dates, numbers, keys, urls, html + the one Arrow dom pass)
  operators  DataFrame operators (filters, joins, dedupe/sets, cut-offs, reports, sorting)
  sources    readers, sinks, and the derived test views shared with the DuckDB oracles
  plans      the 18 region jobs, the shape-A flow and the query registry
  streaming  Structured Streaming ingest / dedupe / upsert
"""

__version__ = "0.1.0"
