def comparable(table):
    """Rows of an arrow table as sorted text tuples, columns by name."""
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*[[repr(v) for v in c] for c in columns]))
