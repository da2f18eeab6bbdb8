"""DataFrame -> DataFrame building blocks: dedup, relational checks, quality."""
