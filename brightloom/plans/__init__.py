"""Registered queries: one per operator, each with its SQL statement where one exists."""
