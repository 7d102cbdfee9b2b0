"""Operators for preparing training data: ten operators, their queries and SQL. Nothing else in gridloam imports them."""
