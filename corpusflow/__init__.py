"""corpusflow: DataFrame operators for text, chat, retrieval and evaluation data on Spark."""

__version__ = "0.1.0"
