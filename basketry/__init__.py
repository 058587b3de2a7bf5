"""E-commerce analytics on PySpark.

Layers, each a set of ``DataFrame -> DataFrame`` functions:

``sources``    raw readers, view registration and partitioned table writes
``functions``  column expressions: dates, money, labels, casts
``operators``  staging, facts, dimensions, aggregates, ranking, quality checks
``plans``      business reports, dashboard panels and the full warehouse build
``streaming``  incremental upserts and Structured Streaming jobs
"""
