"""Readers and writers: files, catalog tables, JDBC, log topics, replayed tables."""
