"""Trip analytics on Spark: profile, clean, derive, aggregate, train and score trips."""
