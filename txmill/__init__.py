"""txmill: Spark DataFrame operators for transaction cleaning and model retraining."""
