"""textloom: building, cleaning and measuring text corpora and subword vocabularies with Spark."""

__version__ = "0.1.0"
