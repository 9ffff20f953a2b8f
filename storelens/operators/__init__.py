"""DataFrame to DataFrame steps that the measures share."""
