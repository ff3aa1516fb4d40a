"""DataFrame operators; the row-level ones run the same in batch and streaming."""
