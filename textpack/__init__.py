"""Spark jobs that prepare text for training: clean, filter, tokenize, order, pack, report."""
