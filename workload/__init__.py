"""The registered queries: every operator on the test tables, with its SQL counterpart."""
