"""Compositions: the stages of the catalogue build and the queries on given tables."""
