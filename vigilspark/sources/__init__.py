"""Reading raw JSON documents and writing result tables."""
