"""Column-level functions: normalisation, quality and the derived fields of a judgment."""
