"""cohortkit: Spark-native cohort, contest and activity analytics.

Every operator is a function from DataFrames to DataFrames; thresholds,
dates and column names are arguments.  Sub-packages:

* ``functions`` – column expressions (month arithmetic, bands, predicates)
* ``sources``   – input contracts and the test-data views
* ``operators`` – the relational building blocks
* ``plans``     – end-to-end programs (lift report, contest dashboard, snapshots)
* ``streaming`` – incremental snapshot job on Structured Streaming
"""

__version__ = "0.1.0"
