"""Model training, resampling and evaluation on Spark ML (M1-M19)."""
