"""Market-data analytics on Spark: ticks, bars, indicators and alerts as DataFrame operators."""
