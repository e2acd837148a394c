"""Readers, writers, lookup loading and model persistence."""

from veld.sources.io import (load_table, save_table, nan_to_null, read_lookup_json,
                             save_model, load_model)

__all__ = ["load_table", "save_table", "nan_to_null", "read_lookup_json", "save_model",
           "load_model"]
