"""Row-level and relational operators of the pipeline (all DataFrame -> DataFrame)."""
