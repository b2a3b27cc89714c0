"""ferry - bulk table transfer through delimited text, as PySpark DataFrame jobs.

The main entry points; see README.md for the design and the full operator list.
"""

from ferry.operators.numbering import identity_generate, row_number
from ferry.operators.skew import skew_join
from ferry.plans.catalog import catalog_from_dir, catalog_from_metastore, plan_preview, select_tables
from ferry.plans.run import (TransferOptions, columns_report, format_layout, plan_transfer, run_export,
                             run_import, transfer, what_if)
from ferry.plans.transfer import (export_all, export_table, fingerprints, import_by_name, import_inferred,
                                  import_table, load_into, metrics_frame, same_content, verify_round_trip)
from ferry.session import checkpoint_dir, local_session, remove_scratch, scratch_path
from ferry.sources.delimited import FileFormat, read_delimited, write_delimited
from ferry.streaming.landing import stream_import

__all__ = [
    "FileFormat", "TransferOptions", "catalog_from_dir", "catalog_from_metastore", "checkpoint_dir",
    "columns_report", "export_all", "export_table", "fingerprints", "identity_generate", "import_by_name",
    "import_inferred", "import_table", "load_into", "local_session", "metrics_frame", "plan_preview",
    "plan_transfer", "read_delimited", "remove_scratch", "row_number", "run_export", "run_import", "same_content", "scratch_path",
    "select_tables", "skew_join", "stream_import", "transfer", "verify_round_trip", "what_if", "write_delimited",
    "format_layout",
]
