"""Readers and writers of records, interval files and binary headers."""
