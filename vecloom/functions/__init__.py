"""Column functions: text, keys, vectors and the encoder plug-in."""
