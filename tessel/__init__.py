"""tessel: DataFrame operators for preparing and auditing text and source-code corpora."""

__version__ = "0.1.0"
