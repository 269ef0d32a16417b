"""The engine's queries over the given parquet tables, and the SQL that checks them."""
