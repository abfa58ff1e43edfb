"""Readers, writers and table loads."""
