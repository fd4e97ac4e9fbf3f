"""Relational building blocks shared by the domain jobs."""
