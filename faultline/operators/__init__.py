"""Analysis operators: DataFrame -> DataFrame functions over an exception log."""
