"""DataFrame operators: quality, uniqueness, integrity and indicator products."""
