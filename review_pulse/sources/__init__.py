"""Readers, message codecs and writers."""
