"""opslens: cleaning and operational analytics for messy trip data on Spark.

Layers
------
functions  column expressions (text, parsing, labels, ratios)
operators  DataFrame operators (dedup, reference filters, ranking, pivots, hops)
sources    schemas, readers, writers, staged tables
plans      the five cleaning pipelines, the reports and the chart summaries
workload   the driver tables presented as raw operational tables
"""
