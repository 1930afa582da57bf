"""DataFrame operators: digests, diffs, audits, catalogue checks, change log."""
