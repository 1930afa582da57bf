"""Column-level building blocks: types, tokens, hashes, text transforms."""
