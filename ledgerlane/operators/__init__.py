"""DataFrame-in, DataFrame-out transformations; none of them runs an action."""
