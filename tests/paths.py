"""Paths in tests."""


def local_path(uri: str) -> str:
    """``file:/x`` -> ``/x`` for plain file operations in tests."""
    return uri[len("file:"):] if uri.startswith("file:") else uri
