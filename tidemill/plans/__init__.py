"""Registered queries, each with its comparison SQL where SQL can say it."""
