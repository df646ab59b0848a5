"""basketry: layered retail analytics on Spark DataFrames and Structured Streaming.

``functions``  column expressions (text, dates, money)
``operators``  DataFrame operators (quality rules, dedup, type-2 history, ranking, star join)
``sources``    readers and writers (CSV feed bound by header name, Parquet tables)
``plans``      the layers: bronze, silver, gold, KPI tables
``streaming``  the same layers as triggered Structured Streaming queries
"""
