"""DataFrame → DataFrame operators: cleaning, aggregates, time series,
contracts, model, scoring and model-version lifecycle."""
