"""Named queries over the retail test tables and their SQL counterparts."""
