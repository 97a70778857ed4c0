"""Table operators: DataFrame in, DataFrame out, nothing runs until an action."""
