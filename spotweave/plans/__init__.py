"""Queries over the driver tables, each with an independent SQL twin where SQL can say it."""
