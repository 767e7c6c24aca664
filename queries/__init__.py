"""The registered queries, the raw tables they start from, and their SQL counterparts."""
