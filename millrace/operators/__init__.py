"""DataFrame-to-DataFrame operators, all usable with ``df.transform``."""
