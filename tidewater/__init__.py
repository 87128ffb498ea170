"""tidewater: Spark-native lookback features, time-split modelling and model diagnostics."""

__version__ = "0.1.0"
