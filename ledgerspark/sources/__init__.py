"""Reading extracts and record files, publishing reports."""
