"""Whole tables: silver, gold, serving and the batch run."""
