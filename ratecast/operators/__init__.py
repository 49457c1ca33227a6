"""DataFrame operators. Every function is lazy: DataFrame in, DataFrame out."""
