"""marquee: a Spark-native warehouse for a game catalogue and its monthly audience data."""

__version__ = "0.1.0"
