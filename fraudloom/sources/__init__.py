"""Reading and writing: CSV, event topics, archive folders, backups."""
