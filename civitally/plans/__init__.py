"""Jobs: the mart catalogue, the mart build, cleaning and forecasting."""
