"""Subscription analytics on Spark DataFrames.

Raw subscriber, plan and subscription tables are cleaned, priced against a
type-2 history of plan prices, enriched and rolled up into two reporting marts.
Every operator takes and returns DataFrames or Columns, runs no action, reads
no clock unless asked to and sets no session configuration.
"""
