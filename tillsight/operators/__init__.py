"""User-level operators, each ``DataFrame(s) -> DataFrame``."""
