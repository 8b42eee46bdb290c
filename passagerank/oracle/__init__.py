"""The same queries as plain SQL over the driver's tables, for an independent check."""

from passagerank.oracle.statements import SQL

__all__ = ["SQL"]
