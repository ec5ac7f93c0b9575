"""Readers, writers and the adapters that shape the test tables into loans and items."""
