"""Readers for tables, event streams and message brokers."""
