"""DataFrame and column operators of the adjudication pipeline."""
