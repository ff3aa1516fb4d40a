"""Checked queries: access-log lines rendered from the ``events`` table, and what to expect."""
