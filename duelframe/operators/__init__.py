"""Table operators (DataFrame -> DataFrame)."""
