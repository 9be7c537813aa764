"""The registered queries over the ``events`` table and their SQL counterparts."""
