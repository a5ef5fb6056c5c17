"""Joins, aggregates, ranking, graph jobs, feature preparation, models and evaluation."""
