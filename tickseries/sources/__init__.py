"""Readers. Paths may be any Hadoop URI."""
