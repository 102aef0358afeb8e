"""Operators for preparing language-model training data with Spark.

Each module holds one operator with a general interface; ``queries.py`` registers the
thin query of each operator. Nothing else in the library imports this subpackage.
"""
