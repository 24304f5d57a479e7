"""Reading and writing postings and pages."""
