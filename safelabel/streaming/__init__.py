"""The batch operators on streams of JSON-lines files."""
