"""Reading and writing of tables and files."""
