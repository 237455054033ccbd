"""Table helpers: each takes and returns a ``DataFrame``, ready for ``df.transform``."""
