"""Readers and append or replace sinks."""
