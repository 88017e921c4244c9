from adpulse.streaming.pipeline import run_until_any_ends, start_pipeline, start_side_streams, streaming_rollup
from adpulse.streaming.sink import TableSink

__all__ = ["TableSink", "run_until_any_ends", "start_pipeline", "start_side_streams", "streaming_rollup"]
