"""DataFrame -> DataFrame operators over a weekly panel."""

from .compiled import compiled, model_sql
from .features import (
    forecast_point_features,
    lag_features,
    rolling_features,
    seasonal_features,
    training_frame,
    trend_feature,
)
from .interval import next_forecast, residual_interval
from .leafwise import LeafwiseModel
from .metrics import regression_metrics
from .model import LEAFWISE, Backtest, ModelParams, backtest, fit_forecaster, score
from .reconcile import (
    deviation_alerts,
    forecast_accuracy,
    forecast_actual_lookup,
    refresh_gate,
)
from .split import chronological_split

__all__ = [
    "LEAFWISE",
    "Backtest",
    "LeafwiseModel",
    "ModelParams",
    "backtest",
    "chronological_split",
    "compiled",
    "deviation_alerts",
    "fit_forecaster",
    "forecast_accuracy",
    "forecast_actual_lookup",
    "forecast_point_features",
    "lag_features",
    "model_sql",
    "next_forecast",
    "refresh_gate",
    "regression_metrics",
    "residual_interval",
    "rolling_features",
    "score",
    "seasonal_features",
    "training_frame",
    "trend_feature",
]
