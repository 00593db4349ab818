"""Reading raw text and snapshots, and writing snapshots and gold files."""
