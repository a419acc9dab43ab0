"""The registered queries: each operator on tables derived from the test data, with its SQL counterpart."""
