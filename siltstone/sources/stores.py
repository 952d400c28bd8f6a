"""Where the source's tables and objects lie, and Arrow tables of them."""

from __future__ import annotations

from typing import Any

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs

from siltstone.plans.options import Store

#: Attempts at an object of a remote store before it counts as an error.
ATTEMPTS = 50


def opened(uri: str, store: Store = Store()) -> tuple[fs.FileSystem, str]:
    """The file system of a URI and the path in it."""
    if uri.startswith(("s3://", "s3a://")) and (store.endpoint or store.identity):
        scheme, _, endpoint = store.endpoint.rpartition("://")
        access = {"access_key": store.identity, "secret_key": store.credential} if store.identity else {}
        s3 = fs.S3FileSystem(endpoint_override=endpoint or None, scheme=scheme or "https", retry_strategy=fs.AwsStandardS3RetryStrategy(max_attempts=ATTEMPTS), **access)
        return s3, uri.partition("://")[2]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def dataset(uri: str, store: Store = Store()) -> ds.Dataset:
    where, path = opened(uri, store)
    return ds.dataset(path, filesystem=where, format="parquet")


def table(uri: str, columns: list[str] | None = None, where: Any = None, store: Store = Store()) -> pa.Table:
    return dataset(uri, store).to_table(columns=columns, filter=where)


def denied(error: OSError) -> bool:
    """Whether a store refused to show an object (as against any other failure)."""
    return isinstance(error, PermissionError) or "ACCESS_DENIED" in str(error) or "HTTP status 403" in str(error)
