"""Scans, parsers and sinks (inventory group A)."""

from .readers import (canonical_timestamps, load_table, newest_snapshot, read_newest,
                      read_dataset, write_table)
from .parsing import (coerce_double, decode_product_code, encode_product_code,
                      extract_list_items, json_arrays_to_rows, locale_double)
from .manifest import dataset_manifest, split_at_years, split_rolling_years

__all__ = [
    "canonical_timestamps", "load_table", "newest_snapshot", "read_newest", "read_dataset",
    "write_table", "coerce_double", "decode_product_code", "encode_product_code",
    "extract_list_items", "json_arrays_to_rows", "locale_double", "dataset_manifest",
    "split_at_years",
    "split_rolling_years",
]
