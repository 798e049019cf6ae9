"""Backup, restore and reporting analytics over data-catalog metadata, as Spark plans."""
