"""objectlake: CRM-style object analytics over lake tables, on Spark."""

from .catalog import Catalog, CatalogError
from .functions import *  # noqa: F401,F403
from .functions import __all__ as _fn_all
from .naming import normalize_columns, normalize_name
from .operators.chunking import chunk_eligibility, key_chunks, read_chunked
from .operators.codec import conformance, decode, encode, flatten, split_attachments, time_field
from .operators.packing import check_packing, global_index, pack_batches
from .operators.widefetch import wide_fetch
from .plans.query import ObjectQuery, QueryError
from .session import apply_settings, checkpoint_dir, local_session, scale_settings, tune
from .sinks.csvbatch import check_results, write_batched, write_csv_batches
from .sinks.write import apply_write, commit, validate_write, write
from .sources.batch import read_source
from .sources.bulkcsv import read_bulk_results
from .streaming.changes import (decode_changes, notify, notify_for_fields, read_changes,
                                start_change_stream, stream_schema)

__all__ = [
    "Catalog", "CatalogError", "ObjectQuery", "QueryError", "normalize_name", "normalize_columns",
    "local_session", "tune", "checkpoint_dir", "scale_settings", "apply_settings",
    "chunk_eligibility", "key_chunks", "read_chunked", "wide_fetch",
    "decode", "encode", "conformance", "flatten", "split_attachments", "time_field",
    "global_index", "pack_batches", "check_packing",
    "write", "apply_write", "validate_write", "commit", "write_csv_batches", "write_batched", "check_results",
    "read_source", "read_bulk_results",
    "read_changes", "decode_changes", "notify", "notify_for_fields", "start_change_stream", "stream_schema",
    *_fn_all,
]
