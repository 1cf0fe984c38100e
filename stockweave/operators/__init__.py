"""DataFrame → DataFrame operators; each one works with ``df.transform``."""
