"""lakeloom: product/review lakehouse operators on Spark.

Modules:
    functions   Column -> Column helpers (text, JSON values, vectors)
    sources     raw JSON-lines source, Parquet / JSON sinks
    operators   ingest, profile, silver, resolve, gold, features, embed, search
    streaming   Structured Streaming ingest
    plans       registered queries over test tables with DuckDB oracles
"""

__version__ = "0.1.0"
