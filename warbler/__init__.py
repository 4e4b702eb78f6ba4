"""warbler: microblog record analytics on Spark DataFrames.

Raw blank-line-delimited records → typed tweet table (Parquet) → topic questions, data-quality
counts, mention graphs and betweenness centrality. Everything is a DataFrame plan built from
``pyspark.sql.functions``; no RDDs and no Python UDFs.
"""

__version__ = "0.1.0"
