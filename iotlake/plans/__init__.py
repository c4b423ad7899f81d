"""Whole jobs and the registered queries, put together from the operators."""
