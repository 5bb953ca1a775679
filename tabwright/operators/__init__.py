"""Table operators: DataFrame in, DataFrame (or report DataFrame) out."""
