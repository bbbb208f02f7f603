"""DataFrame -> DataFrame operators of the layered customer pipeline."""
