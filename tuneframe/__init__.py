"""Spark jobs for preparing fine-tuning data and analysing training and evaluation runs."""

__version__ = "0.1.0"
