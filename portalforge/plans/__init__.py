"""User-level jobs: each is DataFrame(s) -> DataFrame."""
