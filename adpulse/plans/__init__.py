from adpulse.plans.ranges import TimeRange

__all__ = ["TimeRange"]
