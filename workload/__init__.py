"""Queries over the driver tables, one per operator, and the SQL that checks them."""
