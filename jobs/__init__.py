"""Runnable jobs; each module has a command line: python -m jobs.NAME --help."""
