"""foldcast: rolling-origin demand forecasting and backtesting as Spark plans."""
