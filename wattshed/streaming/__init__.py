"""Half-hourly readings as a stream."""
