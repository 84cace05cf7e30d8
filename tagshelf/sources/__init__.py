from .footers import read_filled_columns, stored_counts, stored_null_profile
from .readers import read_delimited, read_parquet, read_records
from .scratch import clear_scratch, drop_scratch, materialize, scratch_path
from .sinks import load_word_model, save_word_model, write_delimited, write_parquet

__all__ = ["read_delimited", "read_parquet", "read_records", "write_delimited", "write_parquet",
           "save_word_model", "load_word_model", "materialize", "scratch_path",
           "clear_scratch", "drop_scratch", "stored_counts", "stored_null_profile", "read_filled_columns"]
