"""The same stateless stages over streams."""
