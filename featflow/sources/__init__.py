"""Readers, writers and keyed feature tables on the session catalog."""
