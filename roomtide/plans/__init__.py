"""End-to-end plans: preprocessing, training frames, forecasting."""
