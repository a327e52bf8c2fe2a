"""ledgerflow: batch-feed analytics on Spark.

Staging files -> cleansed, flagged raw tables -> conformed business
entities, all expressed as DataFrame transformations that Catalyst
plans and Spark distributes.  Every public function takes and returns
DataFrames (or writes them), so steps chain with ``DataFrame.transform``.
"""

__version__ = "0.1.0"
