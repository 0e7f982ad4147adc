"""Bindings of the operators to the check tables, with their SQL counterparts."""
