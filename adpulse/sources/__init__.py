from adpulse.sources.demo_events import json_events, typed_events
from adpulse.sources.records import SourceConfig, read_batch, read_stream
from adpulse.sources.store import ResultStore

__all__ = ["ResultStore", "SourceConfig", "json_events", "read_batch", "read_stream", "typed_events"]
