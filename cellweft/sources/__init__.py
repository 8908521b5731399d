"""Reading and writing cell tables, and the catalog of their columns."""
