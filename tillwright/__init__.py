"""Retail sales marts, data checks and monthly forecasts as Spark jobs."""
