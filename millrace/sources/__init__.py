"""Readers for delimited and plain text, inline rows, watched folders; writers for the results."""
