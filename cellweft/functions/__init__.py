"""Column functions: everything here returns Spark columns, nothing runs Python per row."""
