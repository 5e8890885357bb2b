"""Reading files, tables and documents; writing tables, files and messages."""
