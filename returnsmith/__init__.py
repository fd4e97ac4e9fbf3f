"""Regulatory banking returns as plain PySpark DataFrame functions.

``functions``  column expressions (null rules, money, maturity codes, business rules)
``operators``  relational building blocks (lookup joins, de-duplication, review actions)
``sources``    readers, table bundles and the warehouse extraction layer
``plans``      the domain jobs: enrichment, quality, reconciliation, reports, runs
"""

__version__ = "0.1.0"
