"""Feature, segment, selection and report operators: DataFrame in, DataFrame out."""
