"""Reading the messages column of an Arrow batch without a Python object per message."""

from __future__ import annotations


def turns(column) -> tuple[list[int], list[int], list, list]:
    """Start and end of each row's turns, and the flat roles and contents; a null list has no turns."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten()
    n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).cumsum()
    ends = n.tolist()
    roles, contents = pc.struct_field(flat, "role").to_pylist(), pc.struct_field(flat, "content").to_pylist()
    return [0, *ends[:-1]], ends, roles, contents
