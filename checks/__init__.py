"""Registered queries over the driver tables, their inputs and their SQL counterparts."""
