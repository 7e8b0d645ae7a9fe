"""Column builders: no DataFrame in, no DataFrame out."""
