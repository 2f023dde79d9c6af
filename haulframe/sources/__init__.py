"""Files and tables: readers, writers, managed tables and the shared scratch folder."""
