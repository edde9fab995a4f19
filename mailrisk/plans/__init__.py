"""Workflows: operators put together in the order their results depend on."""
