"""Queries that run the library on the star-schema test tables, each with an independent SQL statement."""
