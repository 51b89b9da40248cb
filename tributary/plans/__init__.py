"""Whole pipelines: the domain binding, the layered build, registered queries."""
