"""Readers, writers, reference data and batches of SQL stages."""
