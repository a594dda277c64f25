"""Promotion-aware retail demand features, validation and forecasts as whole-table Spark jobs."""
