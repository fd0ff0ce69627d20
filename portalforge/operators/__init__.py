"""Relational building blocks: sized joins, interval overlap, ordered
aggregates, long->wide matrix lines, sample-set algebra."""
