"""Readers, writers and schemas."""
