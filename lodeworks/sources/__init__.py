from lodeworks.sources.readers import (
    read_csv_columns, read_lines, read_table, rows_to_df, typed_projection,
)
from lodeworks.sources.scratch import cached, lay_out, materialize, new_path, shared_dir, step
from lodeworks.sources.writers import format_lines, load_model, save_model, write_lines, write_table

__all__ = [
    "cached", "format_lines", "lay_out", "load_model", "materialize", "new_path", "read_csv_columns", "read_lines", "read_table",
    "rows_to_df", "save_model", "shared_dir", "step", "typed_projection", "write_lines", "write_table",
]
