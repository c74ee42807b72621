"""Registered queries: each operator applied to whole tables, with its SQL twin."""
