"""entryflow: keyed-event enrichment and question-and-answer reports on Spark."""

__version__ = "0.1.0"
