"""ledgerlight: advertising-feed canonicalisation and venue reporting on Spark.

Subpackages
-----------
functions   pure ``Column -> Column`` building blocks (dates, text, rule tables, ad-name decoding)
operators   DataFrame operators (canonical projection, lookups, aggregates, slice maintenance)
sources     readers and writers for landed report files
plans       composed jobs: the six feed loads and the nine venue reports
streaming   drop-folder ingestion on the Structured Streaming file source
"""

__all__ = ["session", "fixtures"]
