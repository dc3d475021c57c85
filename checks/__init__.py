"""Queries over the driver's tables, each paired with plain SQL where SQL can say it."""
