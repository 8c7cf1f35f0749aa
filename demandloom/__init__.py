"""Sales forecasting on Spark: calendar features, ARIMAX tuning and scoring, top-down splits."""
