"""Joins, aggregates and row operators the products are composed of."""
