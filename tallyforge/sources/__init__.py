"""Readers, stream readers and writers."""
