"""DataFrame -> DataFrame operators. Each takes keyword options and returns a lazy DataFrame."""
