"""The transaction load as a stream of landed files."""
