"""Incremental maintenance of the silver and gold tables."""
