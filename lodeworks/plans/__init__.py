"""The registered queries: inputs, Spark plans and their SQL counterparts."""
