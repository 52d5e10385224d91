"""How rows are laid out over tasks: lineage cuts, hot keys and row positions."""

from velograph.layout.lineage import cut_lineage, written, written_for_now
from velograph.layout.positions import ROW_ID, number_rows, number_runs, with_row_ids
from velograph.layout.skew import ROWS_PER_TASK, HeavyKeys, SlicedRows, heavy_keys, sliced_table
from velograph.layout.tasks import small_tasks

__all__ = [
    "HeavyKeys",
    "ROWS_PER_TASK",
    "ROW_ID",
    "SlicedRows",
    "cut_lineage",
    "heavy_keys",
    "number_rows",
    "number_runs",
    "sliced_table",
    "small_tasks",
    "with_row_ids",
    "written",
    "written_for_now",
]
