"""Readers: trade and code files, and the star tables the tests run on."""
