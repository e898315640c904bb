"""The registered queries: operators of the package on the given tables, each with its SQL."""
