"""ledgerwide: long-format financial statements to wide KPIs, on Spark.

Layers
------
``sources``    landing reads, staging writes, CSV sinks
``functions``  column expressions (text, fiscal calendar, numbers, status)
``operators``  DataFrame -> DataFrame building blocks (pivot, merge, rank, ...)
``plans``      named views, analyses, checks and exports built from operators
``streaming``  incremental load of a landing folder
"""
