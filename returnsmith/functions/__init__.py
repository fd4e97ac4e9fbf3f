"""Expression texts, in Spark SQL.

Rules are written as SQL text and parsed by Spark: built-in functions only, so everything stays
inside generated code, and one parse per rule instead of one driver call per operator.
"""
