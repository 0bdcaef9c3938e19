"""Operators and queries for preparing language-model training data on Spark.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its queries
when it is present.
"""
