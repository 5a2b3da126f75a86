"""Arrow file systems for folders that Spark names by URI."""

from __future__ import annotations

# Hadoop's scheme names -> Arrow's, where they differ (fixed values)
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}


def arrow_uri(uri: str) -> str:
    scheme, sep, rest = uri.partition("://")
    if sep and scheme in SCHEMES:
        return f"{SCHEMES[scheme]}://{rest}"
    if uri.startswith("file:/") and not sep:  # Hadoop prints file:/path
        return "file://" + uri[5:]
    return uri


def filesystem(uri: str):
    """(file system, path in it) of a folder or file URI or absolute path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(arrow_uri(uri))
