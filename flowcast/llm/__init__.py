"""Operators of a training-data pipeline, their queries and SQL; nothing else imports them."""
