"""adpulse: ad-event stream analytics on Spark (windowed traffic metrics, bot alerts, data quality)."""

from adpulse.config import PipelineConfig, Thresholds

__all__ = ["PipelineConfig", "Thresholds"]
