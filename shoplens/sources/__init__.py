"""Readers and writers for the five input tables and the result lists."""
