"""Curation of agent traces and text corpora on Spark."""
