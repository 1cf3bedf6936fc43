"""Medication-supply curation and visit forecasting as Spark jobs."""

from dosecast.params import ForecastParams
from dosecast.plans.forecast import forecast

__all__ = ["ForecastParams", "forecast"]
