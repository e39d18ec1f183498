"""Test-table adapters, registered queries and their oracle SQL."""
