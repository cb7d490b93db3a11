"""Operators for preparing training text, each with its query; nothing else imports them."""

from conform.llm.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
