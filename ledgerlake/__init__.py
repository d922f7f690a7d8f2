"""Spark-native card-payments medallion pipeline.

Bronze (decode, parse, validate, fraud rules, routing), Silver (dedup, types,
cleaning) and Gold (star schema) as DataFrame operators and jobs.
"""

__version__ = "0.1.0"
