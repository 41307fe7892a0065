"""Readers and writers; every path is a Hadoop URI."""
