"""Readers and writers: page and response JSON, snapshots, files."""
