"""Readers and writers of the bronze layer (files, relational, series API)."""
