"""Operators of a training-data pipeline.

One module per operator; ``queries`` collects the registered queries and their
oracle SQL.  Nothing else in the library imports this subpackage.
"""
