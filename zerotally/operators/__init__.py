"""DataFrame operators: filters, views, ranks, encoders, models, metrics."""
