"""Column helpers: each takes and returns a ``Column``, so all of them also run on streams."""
