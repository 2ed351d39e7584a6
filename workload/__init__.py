"""The registered queries: test tables mapped to the library's inputs, and their SQL counterparts."""
